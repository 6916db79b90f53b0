"""Registered queries: table changes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import oracle as o
from ..operators import changes as cg
from ..operators.scan import freeze
from ..session import scratch_path
from ..sources import bindings as b
from .registry import register

KEY = "o_orderkey"
SET_COL = "o_totalprice"
# --- fixed values: defaults of a freshly inserted order row (M9) ---------------
ORDER_DEFAULTS = {"o_orderstatus": "O", "o_orderpriority": "5-LOW"}
# ---------------------------------------------------------------------------------
ROLLBACK_TO = 900
ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def orders(spark, d):
    return b.table(spark, d, "orders").select(*[c.strip() for c in ORDER_COLS.split(",")])


def _applied(spark, d):
    return cg.apply_changes(b.order_rows(spark, d), b.changes(spark, d), KEY, SET_COL, ORDER_DEFAULTS,
                            b.gated_targets(spark, d))


def _rolled_back(spark, d):
    base = b.order_rows(spark, d)
    st = freeze(cg.change_status(b.changes(spark, d), base, KEY, gate=b.gated_targets(spark, d)))
    return cg.rollback_changes(base, st, b.change_scripts(spark, d), KEY, SET_COL, ROLLBACK_TO, ORDER_DEFAULTS)


_STATUS_LOCAL = [
    ("ch", "SELECT c.*, b.o_orderkey IS NOT NULL AS in_base FROM changes c LEFT JOIN "
           "(SELECT DISTINCT target_id, o_orderkey FROM order_rows) b ON b.o_orderkey = c.o_orderkey "
           "AND b.target_id = c.target_id"),
    ("st0", "SELECT *, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (PARTITION BY target_id, "
            "o_orderkey ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_reset FROM ch"),
    ("st1", "SELECT *, CASE WHEN prev_reset = 'insert' THEN true WHEN prev_reset = 'delete' THEN false "
            "ELSE in_base END AS exists_before FROM st0"),
    ("st2", "SELECT *, (op = 'insert' AND exists_before) OR (op IN ('insert', 'update') AND value IS NULL) "
            "AS fails FROM st1"),
    ("ff", "SELECT target_id, min(version) AS first_fail FROM st2 WHERE fails GROUP BY target_id"),
    ("st", "SELECT s.*, CASE WHEN g.target_id IS NOT NULL THEN 'blocked' WHEN f.first_fail IS NULL OR "
           "s.version < f.first_fail THEN 'applied' WHEN s.version = f.first_fail THEN 'failed' ELSE 'blocked' END AS status "
           "FROM st2 s LEFT JOIN ff f ON f.target_id = s.target_id LEFT JOIN gated g ON g.target_id = s.target_id"),
    ("bad", "SELECT DISTINCT s.target_id FROM st s LEFT JOIN change_scripts c ON c.target_id = s.target_id "
            f"AND c.version = s.version WHERE s.status = 'applied' AND s.version > {ROLLBACK_TO} "
            "AND NOT coalesce(c.has_rollback, false)"),
]
_NEEDS = ("changes", "order_rows", "gated", "change_scripts")


def _fold_local(rollback=False):
    cond = "status = 'applied'"
    if rollback:
        cond += f" AND (version <= {ROLLBACK_TO} OR target_id IN (SELECT target_id FROM bad))"
    return _STATUS_LOCAL + [
        ("fs", "SELECT target_id, o_orderkey, arg_max(op, version) FILTER (WHERE op <> 'update') AS last_reset, "
               f"arg_max_null(value, version) AS last_value FROM st WHERE {cond} GROUP BY target_id, o_orderkey")]


_TABLE_SQL = """
SELECT coalesce(o.target_id, s.target_id) AS target_id, coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN s.last_reset = 'insert' THEN NULL ELSE o.o_custkey END AS o_custkey,
  CASE WHEN s.last_reset = 'insert' THEN 'O' ELSE o.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.last_value ELSE o.o_totalprice END AS o_totalprice,
  CASE WHEN s.last_reset = 'insert' THEN NULL ELSE o.o_orderdate END AS o_orderdate,
  CASE WHEN s.last_reset = 'insert' THEN '5-LOW' ELSE o.o_orderpriority END AS o_orderpriority
FROM order_rows o FULL OUTER JOIN fs s ON s.o_orderkey = o.o_orderkey AND s.target_id = o.target_id
WHERE s.o_orderkey IS NULL OR s.last_reset = 'insert' OR (s.last_reset IS NULL AND o.o_orderkey IS NOT NULL)"""


@register("change_status", o.sql(
    "SELECT target_id, version, o_orderkey, op, exists_before, fails, status FROM st", *_NEEDS,
    local=_STATUS_LOCAL))
def change_status(spark, d):
    """R7 step: per change, whether its key exists before it, whether a data
    check rejects it, and applied / failed / blocked (W8 per target)."""
    _, st = _applied(spark, d)
    return st.select("target_id", "version", "o_orderkey", "op", "exists_before", "fails", "status")


@register("apply_changes", o.sql(_TABLE_SQL, *_NEEDS, local=_fold_local()))
def apply_changes(spark, d):
    """Orders after all applicable changes (copy-on-write snapshot)."""
    return _applied(spark, d)[0]


@register("apply_ledger_events", o.sql(
    "SELECT target_id, version, 'start' AS op FROM st WHERE status <> 'blocked' UNION ALL "
    "SELECT target_id, version, CASE WHEN status = 'applied' THEN 'success' ELSE 'failure' END FROM st "
    "WHERE status <> 'blocked'", *_NEEDS, local=_STATUS_LOCAL))
def apply_ledger_events(spark, d):
    """R7 ledger output (L1-L3 events)."""
    return cg.ledger_events(_applied(spark, d)[1])


@register("dry_run", o.sql(
    "SELECT target_id, op, status, count(*) AS changes FROM st GROUP BY target_id, op, status", *_NEEDS,
    local=_STATUS_LOCAL))
def dry_run(spark, d):
    """What R7 would do, counted per target, op and outcome."""
    return cg.dry_run(_applied(spark, d)[1])


@register("rollback_changes", o.sql(_TABLE_SQL, *_NEEDS, local=_fold_local(rollback=True)))
def rollback_changes(spark, d):
    """Orders as of change version 900, for the targets whose later
    changes all have a Down section; the others keep theirs (Q21)."""
    return _rolled_back(spark, d)[0]


@register("rollback_events", o.sql(
    f"SELECT target_id, version, 'remove' AS op FROM st WHERE status = 'applied' AND version > {ROLLBACK_TO} "
    "AND target_id NOT IN (SELECT target_id FROM bad)", *_NEEDS, local=_STATUS_LOCAL))
def rollback_events(spark, d):
    """R9 ledger output: remove events of the undone changes."""
    return _rolled_back(spark, d)[1]


@register("create_table", o.sql(f"SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus = 'F'"))
def create_table(spark, d):
    """M1: CREATE TABLE IF NOT EXISTS with the schema of orders, filled with
    the finished ones, created once more (nothing changes), read back; the
    table leaves the catalog, its files stay for the result."""
    name, path = f"orders_{uuid.uuid4().hex[:12]}", scratch_path(spark, "tables")
    base = orders(spark, d)
    for _ in range(2):
        cg.create_table(spark, name, base.schema, path)
        if not spark.table(name).limit(1).count():
            base.where(F.col("o_orderstatus") == "F").write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(base.schema).parquet(path)


_INSERTS = ("SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, 'O' AS o_orderstatus, value AS o_totalprice, "
            "CAST(NULL AS TIMESTAMP) AS o_orderdate, '5-LOW' AS o_orderpriority FROM changes WHERE op = 'insert'")


def _inserts(spark, d):
    rows = b.changes(spark, d).where(F.col("op") == "insert").select(
        KEY, F.col("value").alias(SET_COL))
    base = orders(spark, d)
    full = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in base.schema.fields])
    return cg.apply_defaults(full, ORDER_DEFAULTS)


@register("insert_rows", o.sql(f"SELECT {ORDER_COLS} FROM orders UNION ALL {_INSERTS}", "changes"))
def insert_rows(spark, d):
    """M2: append the inserted rows."""
    return cg.insert_rows(orders(spark, d), _inserts(spark, d))


@register("apply_defaults", o.sql(_INSERTS, "changes"))
def apply_defaults(spark, d):
    """M9: inserted rows completed with the column defaults."""
    return _inserts(spark, d)


@register("update_where", o.sql(
    f"SELECT o.target_id, o.o_orderkey, CASE WHEN u.o_orderkey IS NOT NULL THEN u.v ELSE o.o_totalprice END AS "
    "o_totalprice FROM order_rows o LEFT JOIN ("
    "SELECT target_id, o_orderkey, arg_max_null(value, version) AS v FROM changes WHERE op = 'update' "
    "GROUP BY target_id, o_orderkey) u ON u.o_orderkey = o.o_orderkey AND u.target_id = o.target_id",
    "changes", "order_rows"))
def update_where(spark, d):
    """M3: set the price where the key has an update (latest wins, NULL too)."""
    ups = b.changes(spark, d).where(F.col("op") == "update")
    return cg.update_where(b.order_rows(spark, d), ups, ["target_id", KEY], SET_COL).select("target_id", KEY, SET_COL)


@register("delete_where", o.sql(
    "SELECT o_orderkey FROM orders WHERE NOT coalesce(nullif(o_orderstatus, 'O') = 'F' AND o_totalprice > 150000, "
    "false)"))
def delete_where(spark, d):
    """M4: delete by predicate; rows where it is NULL ('O' orders) stay."""
    cond = (F.nullif(F.col("o_orderstatus"), F.lit("O")) == "F") & (F.col("o_totalprice") > 150000)
    return cg.delete_where(orders(spark, d), cond).select(KEY)


@register("add_column", o.sql("SELECT o_orderkey, CAST(NULL AS VARCHAR) AS o_comment FROM orders"))
def add_column(spark, d):
    """M7."""
    return cg.add_column(orders(spark, d), "o_comment", "string").select(KEY, "o_comment")


@register("check_unique", o.sql(
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey, l_linenumber "
    "HAVING count(*) > 1"))
def check_unique(spark, d):
    """(l_orderkey, l_linenumber) as a would-be primary key."""
    li = b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return cg.check_unique(li, ["l_orderkey", "l_linenumber"])


@register("check_not_null", o.sql(" UNION ALL ".join(
    f"SELECT 'changes' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM changes"
    for c in ("target_id", "version", "o_orderkey", "op", "value")), "changes"))
def check_not_null(spark, d):
    """NULL count per column of the changes."""
    return cg.check_not_null(b.changes(spark, d), "changes")


@register("check_foreign_key", o.sql(
    "SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c "
    "WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)"))
def check_foreign_key(spark, d):
    """Orders whose customer is missing among customers in credit."""
    cust = b.table(spark, d, "customer").where(F.col("c_acctbal") > 0)
    return cg.check_foreign_key(orders(spark, d).select(KEY, "o_custkey"), cust, "o_custkey", "c_custkey")


@register("cascade_delete", o.sql(
    "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey "
    "AND c.c_acctbal <= 0)"))
def cascade_delete(spark, d):
    """Deleting customers in debit removes their orders."""
    gone = b.table(spark, d, "customer").where(F.col("c_acctbal") <= 0)
    return cg.cascade_delete(orders(spark, d).select(KEY, "o_custkey"), gone, "o_custkey", "c_custkey").select(KEY)


@register("child_counts", o.sql(
    "SELECT c.c_custkey, c.c_name, count(o.o_orderkey) AS post_count FROM customer c LEFT JOIN orders o "
    "ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, c.c_name"))
def child_counts(spark, d):
    """The user_stats view: every customer with its order count."""
    cust = b.table(spark, d, "customer").select("c_custkey", "c_name")
    return cg.child_counts(cust, orders(spark, d).select("o_custkey"), "c_custkey", "o_custkey", "post_count")


@register("replace_view", o.sql(
    "SELECT target_id, version, executed_at, execution_count, "
    "'R__create_views executed at ' || CAST(executed_at AS VARCHAR) AS description FROM ("
    "SELECT target_id, version, max(ts) AS executed_at, count(*) AS execution_count FROM ledger_log "
    "WHERE op = 'start' GROUP BY target_id, version)", "ledger_log"))
def replace_view(spark, d):
    """M8: drop-and-recreate of the execution summary view over the log."""
    log = b.ledger_log(spark, d).where(F.col("op") == "start")
    summary = log.groupBy("target_id", "version").agg(F.max("ts").alias("executed_at"),
                                                      F.count(F.lit(1)).alias("execution_count"))
    view = summary.withColumn("description", F.concat(F.lit("R__create_views executed at "),
                                                      F.col("executed_at").cast("string")))
    name = f"migration_execution_summary_{uuid.uuid4().hex[:12]}"
    cg.replace_view(view, name)
    out = spark.table(name)
    spark.catalog.dropTempView(name)        # the result keeps its plan
    return out
