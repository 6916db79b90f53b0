"""Run registered queries on Spark and their DuckDB twins and compare them
the way the driver does: row count, column names, order-free values.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerfleet.sources.bindings import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "StringType": "VARCHAR", "BooleanType": "BOOLEAN",
                 "DoubleType": "DOUBLE", "TimestampNTZType": "TIMESTAMP", "DateType": "DATE", "FloatType": "FLOAT",
                 "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def type_mismatches(sdf, rel):
    """Columns whose Spark type does not map to the DuckDB type."""
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
        got = d_types.get(f.name)
        if got is not None and got != want and not (got == "\"NULL\"" or got == "NULL"):
            out.append(f"{f.name}: spark {want} duck {got}")
    return out


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res = dict(name=name, rows=len(s_rows), duck_rows=len(d_rows), spark_s=round(t1 - t0, 2))
    if sorted(s_cols) != sorted(d_cols):
        res.update(ok=False, why=f"columns {sorted(s_cols)} vs {sorted(d_cols)}")
        return res
    bad_types = type_mismatches(sdf, rel)
    if bad_types:
        res.update(ok=False, why=f"types {bad_types}")
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res.update(ok=False, why=f"values differ; spark-only {diff_a} duck-only {diff_b}")
        return res
    res.update(ok=True)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from ledgerfleet.session import build_session
    import __spark_entry__ as E
    if os.environ.get("PLAIN_SESSION"):
        # what a caller with default settings would have (no ledgerfleet conf)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.sql.session.timeZone", os.environ["PLAIN_SESSION"]).getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, sf_dir, name, fn, orc.get(name))
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
