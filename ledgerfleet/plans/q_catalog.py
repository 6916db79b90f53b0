"""Registered queries: catalog, snapshot, expected objects, schema check and
the corpus generator (S8-S11, J11, J14, M5, R10, T1, T2, T4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as o
from ..operators import catalog as ct
from ..operators import reconcile as rc
from ..operators.scan import ordinal
from ..sources import bindings as b
from .q_corpus import _objects_sql
from . import inputs
from .registry import register


def scripts(spark, d):
    """The corpus seen through its DDL names (one frozen pass over the text)."""
    return inputs.ddl(spark, d)


def catalog(spark, d):
    return b.catalog(spark, d, scripts(spark, d))


_SYS = ("NOT coalesce((dialect = 'PostgreSQL' AND schema_name IN ('information_schema', 'pg_catalog')) OR "
        "(dialect = 'MySQL' AND schema_name IN ('information_schema', 'mysql', 'performance_schema', 'sys')) OR "
        "(dialect = 'SQLite' AND object_type = 'table' AND starts_with(lower(object_name), 'sqlite_')), false)")


@register("catalog_inventory", o.sql(
    f"SELECT * FROM catalog WHERE {_SYS}", "catalog"))
def catalog_inventory(spark, d):
    """Tables, views and other objects per target, without system objects."""
    return ct.inventory(catalog(spark, d))


@register("user_tables", o.sql(
    f"SELECT * FROM catalog WHERE {_SYS} AND object_type = 'table' "
    "AND NOT is_temporary AND object_name <> 'schema_migrations'", "catalog"))
def user_tables(spark, d):
    """S9."""
    return ct.user_tables(catalog(spark, d))


_SNAP_LOCAL = [
    ("objs", f"SELECT target_id, object_name, row_number() OVER (PARTITION BY target_id ORDER BY object_name) "
             f"AS obj_pos FROM (SELECT DISTINCT target_id, object_name FROM catalog WHERE {_SYS} "
             "AND object_name <> 'schema_migrations')"),
    ("vers", "SELECT target_id, max(version) AS baseline_version FROM ledger WHERE migration_type = 'baseline' "
             "GROUP BY target_id"),
    ("cnt", "SELECT v.target_id, v.baseline_version, count(o.object_name) AS n FROM vers v "
            "LEFT JOIN objs o ON o.target_id = v.target_id GROUP BY v.target_id, v.baseline_version"),
]


@register("schema_snapshot", o.sql(
    "SELECT o.target_id, v.baseline_version, o.obj_pos + 2 AS line_no, printf('-- Table: %s', o.object_name) AS line "
    "FROM objs o JOIN vers v ON v.target_id = o.target_id "
    "UNION ALL SELECT target_id, baseline_version, 1, printf('-- Schema dump for baseline version %d', "
    "baseline_version) FROM cnt UNION ALL SELECT target_id, baseline_version, 2, '-- Tables found:' FROM cnt "
    "UNION ALL SELECT target_id, baseline_version, n + 3, '-- This is a baseline marker - no actual DDL to execute' "
    "FROM cnt UNION ALL SELECT target_id, baseline_version, n + 4, printf('-- Database was baselined at version %d', "
    "baseline_version) FROM cnt", "catalog", "ledger", local=_SNAP_LOCAL))
def schema_snapshot(spark, d):
    """The baseline snapshot of every target as numbered lines."""
    return ct.snapshot_lines(catalog(spark, d), rc.baseline_version(inputs.baselines(spark, d)))


_GEN_TABLES = ("SELECT 'test_table_' || CAST(s_suppkey AS VARCHAR) AS table_name, "
               "row_number() OVER (ORDER BY s_suppkey) AS table_pos FROM supplier")


def _gen_tables(spark, d):
    s = b.table(spark, d, "supplier").select("s_suppkey")
    t = s.select(F.concat(F.lit("test_table_"), F.col("s_suppkey").cast("string")).alias("table_name"), "s_suppkey")
    return ordinal(t, [], [F.col("s_suppkey")], "table_pos").select("table_name", "table_pos")


_OPS_SQL = " UNION ALL ".join(f"SELECT {i} AS op_index, '{op}' AS op" for i, op in enumerate(ct.GEN_OPS))


@register("cross_generate", o.sql(
    f"SELECT t.table_name, x.op_index, x.op FROM ({_GEN_TABLES}) t, ({_OPS_SQL}) x"))
def cross_generate(spark, d):
    """Every supplier table x the five operations (an explode of the
    fixed operation list, not a join)."""
    return ct.generate_corpus(_gen_tables(spark, d)).select("table_name", "op_index", "op")


def _rand(k: int) -> str:
    return f"((version * 1103515245 + {12345 * k}) % {ct.RANDOM_RANGE})"


@register("corpus_generate", o.sql(
    "SELECT table_name, version, op, printf('%04d_%s_%s.sql', version, lower(op), table_name) AS path, CASE op "
    f"WHEN 'CREATE' THEN printf('{ct.GEN_TEMPLATES['CREATE']}', table_name) "
    f"WHEN 'INSERT' THEN printf('{ct.GEN_TEMPLATES['INSERT'].replace(chr(39), chr(39) * 2)}', table_name, "
    f"{_rand(1)}, {_rand(2)}) "
    f"WHEN 'UPDATE' THEN printf('{ct.GEN_TEMPLATES['UPDATE'].replace(chr(39), chr(39) * 2)}', table_name, "
    f"{_rand(3)}, {_rand(4)} % {ct.ID_RANGE}) "
    f"WHEN 'DELETE' THEN printf('{ct.GEN_TEMPLATES['DELETE']}', table_name, {_rand(1)} % {ct.ID_RANGE}) "
    f"ELSE printf('{ct.GEN_TEMPLATES['DROP']}', table_name) END AS body FROM ("
    f"SELECT t.table_name, x.op, CAST((t.table_pos - 1) * {len(ct.GEN_OPS)} + x.op_index + 1 AS BIGINT) AS version "
    f"FROM ({_GEN_TABLES}) t, ({_OPS_SQL}) x)"))
def corpus_generate(spark, d):
    """A synthetic corpus, five scripts per supplier table, numbered."""
    return ct.generate_corpus(_gen_tables(spark, d)).select("table_name", "version", "op", "path", "body")


_CREATED = _objects_sql("CREATE TABLE", "create_table")
_DROPPED = _objects_sql("DROP TABLE", "drop_table")


@register("expected_objects", o.sql(
    f"SELECT target_id, object_name FROM ({_CREATED}) EXCEPT SELECT target_id, object_name FROM ({_DROPPED})",
    "scripts"))
def expected_objects(spark, d):
    """Created EXCEPT dropped, per target."""
    return ct.expected_tables(scripts(spark, d))


@register("dropped_again", o.sql(
    f"SELECT target_id, object_name FROM ({_CREATED}) INTERSECT SELECT target_id, object_name FROM ({_DROPPED})",
    "scripts"))
def dropped_again(spark, d):
    """Created INTERSECT dropped, per target."""
    return ct.dropped_again(scripts(spark, d))


@register("distinct_objects", o.sql(
    f"SELECT DISTINCT target_id, object_name FROM ({_CREATED})", "scripts"))
def distinct_objects(spark, d):
    """T4: the set of created table names per target."""
    return ct.objects(scripts(spark, d), "CREATE TABLE")


@register("missing_objects", o.sql(
    f"SELECT target_id, object_name FROM (SELECT target_id, object_name FROM ({_CREATED}) EXCEPT "
    f"SELECT target_id, object_name FROM ({_DROPPED})) e WHERE NOT EXISTS (SELECT 1 FROM catalog c "
    f"WHERE c.target_id = e.target_id AND lower(c.object_name) = e.object_name AND c.object_type = 'table' AND "
    f"{_SYS})", "scripts", "catalog"))
def missing_objects(spark, d):
    """Expected tables the catalog does not report."""
    return ct.missing_objects(ct.expected_tables(scripts(spark, d)), catalog(spark, d), "table")


@register("schema_check", o.sql(
    f"SELECT e.target_id, 'table' AS object_type, e.object_name, CASE WHEN EXISTS (SELECT 1 FROM catalog c "
    f"WHERE c.target_id = e.target_id AND lower(c.object_name) = e.object_name AND c.object_type = 'table' AND "
    f"{_SYS}) THEN 'PRESENT' ELSE 'MISSING' END AS status FROM ("
    f"SELECT target_id, object_name FROM ({_CREATED}) EXCEPT SELECT target_id, object_name FROM ({_DROPPED})) e "
    f"UNION ALL SELECT i.target_id, 'index', i.object_name, CASE WHEN EXISTS (SELECT 1 FROM catalog c "
    f"WHERE c.target_id = i.target_id AND lower(c.object_name) = i.object_name AND c.object_type = 'index') "
    f"THEN 'PRESENT' ELSE 'MISSING' END FROM ({_objects_sql('CREATE INDEX', 'create_index')}) i "
    f"UNION ALL SELECT target_id, 'table', object_name, 'SKIPPED_DROPPED' FROM ("
    f"SELECT target_id, object_name FROM ({_CREATED}) INTERSECT SELECT target_id, object_name FROM ({_DROPPED}))",
    "scripts", "catalog"))
def schema_check(spark, d):
    """Expected tables and indexes against the catalog snapshot."""
    return ct.schema_check(scripts(spark, d), catalog(spark, d))


@register("drop_table", o.sql(
    f"SELECT c.* FROM catalog c WHERE NOT (c.object_type = 'table' AND EXISTS (SELECT 1 FROM ({_DROPPED}) x "
    "WHERE x.target_id = c.target_id AND x.object_name = c.object_name))", "scripts", "catalog"))
def drop_table(spark, d):
    """M5: each target's catalog after its DROP TABLE statements."""
    dropped = ct.objects(scripts(spark, d), "DROP TABLE")
    return ct.drop_tables(catalog(spark, d), dropped)
