"""J10 over a table of patterns: equal to the expressions, open to new rows."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from ledgerfleet.functions import dialects as dl
from ledgerfleet.operators import patterns as pt

CONNS = ["postgresql://u@h/db", "PostgreSQL Unicode", "mysql://h", "sqlite:///x.db", "dsn=foo", "postgres and mysql", "", "pg",
         "Driver=SQLite3 ODBC", "MARIADB", None, "ab", "x\nmysql\ny", "İpostgreSQLİ", "psqlODBC", "mysqlmysqlmysql", "é𝒳mysql𝒳"]


def frame(spark, texts=CONNS):
    return spark.createDataFrame(list(enumerate(texts)), "conn_id long, conn string")


def by_expression(conns, specs=dl.DIALECTS):
    return conns.select("conn_id", F.explode(dl.candidates("conn", specs)).alias("c")).select(
        "conn_id", "c.name", (-F.col("c.neg_conf")).alias("conf"), "c.pattern")


def same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("known", [0, pt.KNOWN_KEYS])
def test_table_equals_the_expressions(spark, known):
    conns = frame(spark)
    found = pt.detected(conns, pt.pattern_table(spark), known_keys=known)
    same(found, by_expression(conns))
    want = conns.select("conn_id", *[v.alias(k) for k, v in dl.best_match(dl.candidates("conn")).items()])
    same(pt.best_matches(found), want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_dialect_is_added_as_a_row(spark):
    conns = frame(spark, ["oracle:thin:@h", "ORA-x", "mysql://oracle", "db2", "ü#7"])
    rows = spark.createDataFrame([("Oracle", 0, 9, "oracle:.*", "oracle:.*", False, "oracle"), ("Oracle", 1, 8, "ORA.*", "ORA.*", True, "ora"),
                                  ("Db2", 0, 9, "db.$", "db.$", False, None), ("Odd", 0, 7, "#", None, False, "#")], pt.PATTERN_SCHEMA)
    table = pt.pattern_table(spark).unionByName(rows)
    got = {(r.conn_id, r.name, r.conf, r.pattern) for r in pt.detected(conns, table).collect() if r.name != dl.FALLBACK_DIALECT}
    assert got == {(0, "Oracle", 9, "oracle:.*"), (1, "Oracle", 8, "ORA.*"), (2, "MySQL", 9, "mysql://.*"), (3, "Db2", 9, "db.$"),
                   (4, "Odd", 7, "#")}
    spec = {"name": "Oracle", "aliases": ["ora"], "connection": ["oracle:.*"], "driver": ["ORA.*"], "substrings": [],
            "substring_label": None, "detects": True}
    own = dl.with_dialect(spec)
    same(pt.detected(conns, pt.pattern_table(spark, own)), by_expression(conns, own))
    assert conns.select(dl.resolve(F.lit("ora"), own)).first()[0] == "Oracle"
    assert conns.select(dl.resolve(F.lit("ora"))).first()[0] == dl.FALLBACK_DIALECT     # the built-in registry is as it was


def test_many_patterns_cost_their_matches(spark):
    specs = [{"name": f"d{k}", "aliases": [], "connection": [f"srv{k:04d}://.*"], "driver": [], "substrings": [f"{k:04d}srv"],
              "substring_label": f"{k:04d}srv", "detects": True} for k in range(2000)]
    conns = spark.range(3000).select(F.col("id").alias("conn_id"), F.format_string("srv%04d://h", F.col("id")).alias("conn"))
    got = pt.detected(conns, pt.pattern_table(spark, specs)).where(F.col("name") != dl.FALLBACK_DIALECT).collect()
    assert sorted((r.conn_id, r.name) for r in got) == [(k, f"d{k}") for k in range(2000)]


@settings(max_examples=300, deadline=None)
@given(hs.text("ab.*?+^$", max_size=9), hs.text("abc", max_size=12))
def test_required_literal_is_in_every_match(pattern, text):
    try:
        found = re.search(pattern, text)
    except re.error:
        return
    literal = pt.required_literal(pattern)
    assert not found or literal is None or literal in text


def test_required_literals_of_the_registry():
    assert [pt.required_literal(p) for p in ["postgresql://.*", ".*mariadb.*", "SQLite3.*", "ab", "a|b", "abcd*e", "xyz?abc", "ab+cde"]] == [
        "postgresql://", "mariadb", "sqlite3", None, None, "abc", "abc", "cde"]
