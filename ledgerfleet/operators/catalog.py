"""Catalog inventory, schema snapshot, expected-object sets and the corpus
generator (S8-S11, J11, J14, M5, R10, T1, T2, T4).

A catalog is a DataFrame (target_id, dialect, schema_name, object_type,
object_name, is_temporary), object_type being table, view, index or sequence.
For the live Spark session it comes from ``SHOW`` statements, which are
DataFrames themselves.  System objects are told by their schema; only SQLite,
which has none, tells them by a name prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scripts as fs
from ..model import LEDGER_TABLE
from .joins import per_target_join
from .scan import freeze, ordinal

# --- fixed values: system objects never listed, snapshot text, generator ------
SYSTEM_SCHEMAS = {"PostgreSQL": ["information_schema", "pg_catalog"],
                  "MySQL": ["information_schema", "mysql", "performance_schema", "sys"]}
SQLITE_PREFIX = "sqlite_"
SNAPSHOT_HEADER = "-- Schema dump for baseline version %d"
SNAPSHOT_TABLES = "-- Tables found:"
SNAPSHOT_TABLE = "-- Table: %s"
SNAPSHOT_MARKER = "-- This is a baseline marker - no actual DDL to execute"
SNAPSHOT_FOOTER = "-- Database was baselined at version %d"
GEN_OPS = ["CREATE", "INSERT", "UPDATE", "DELETE", "DROP"]
GEN_TEMPLATES = {
    "CREATE": "CREATE TABLE IF NOT EXISTS %s (id INT PRIMARY KEY, data TEXT);",
    "INSERT": "INSERT INTO %s (id, data) VALUES (%d, 'test_data_%d');",
    "UPDATE": "UPDATE %s SET data = 'updated_%d' WHERE id = %d;",
    "DELETE": "DELETE FROM %s WHERE id = %d;",
    "DROP": "DROP TABLE IF EXISTS %s;",
}
RANDOM_RANGE = 32768          # the shell's $RANDOM is 0..32767
ID_RANGE = 100                # ids updated / deleted are $RANDOM % 100
# ---------------------------------------------------------------------------------


def live_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """S8 on the running session: tables and views of a database (of the
    current one by default), temporary views included."""
    where = f" IN {database}" if database else ""
    views = (spark.sql("SHOW VIEWS" + where)
             .select("namespace", F.col("viewName").alias("object_name"), "isTemporary").withColumn("_view", F.lit(True)))
    every = spark.sql("SHOW TABLES" + where).select("namespace", F.col("tableName").alias("object_name"), "isTemporary")
    return (every.join(views, ["namespace", "object_name", "isTemporary"], "left")
            .select(F.lit("session").alias("target_id"), F.lit("Databricks").alias("dialect"),
                    F.coalesce("namespace", F.lit("")).alias("schema_name"),
                    F.when(F.col("_view"), F.lit("view")).otherwise(F.lit("table")).alias("object_type"),
                    "object_name", F.col("isTemporary").alias("is_temporary")))


def live_schemas(spark: SparkSession) -> DataFrame:
    """The schema names of the running session."""
    return spark.sql("SHOW DATABASES").select(F.col("namespace").alias("schema_name"))


def is_system_object():
    """Whether a catalog row belongs to the database system of its dialect."""
    cond = (F.col("dialect") == "SQLite") & (F.col("object_type") == "table") \
        & F.lower("object_name").startswith(SQLITE_PREFIX)
    for dialect, schemas in SYSTEM_SCHEMAS.items():
        cond = cond | ((F.col("dialect") == dialect) & F.col("schema_name").isin(*schemas))
    return F.coalesce(cond, F.lit(False))


def inventory(catalog: DataFrame) -> DataFrame:
    """The object list without system objects."""
    return catalog.where(~is_system_object())


def user_tables(catalog: DataFrame) -> DataFrame:
    """User tables: not temporary, not the ledger table."""
    return inventory(catalog).where((F.col("object_type") == "table") & ~F.col("is_temporary")
                                    & (F.col("object_name") != LEDGER_TABLE))


def snapshot_lines(catalog: DataFrame, versions: DataFrame) -> DataFrame:
    """The baseline snapshot of each target as numbered text lines
    (header, one line per object by name, marker, footer); the ledger table is
    left out.  ``versions`` has (target_id, baseline_version).  Write with
    ``write_snapshot``."""
    objs = (inventory(catalog).where(F.col("object_name") != LEDGER_TABLE)
            .select("target_id", "object_name").distinct())
    objs = ordinal(freeze(objs), ["target_id"], [F.col("object_name")], "obj_pos")
    body = per_target_join(objs, versions, ["target_id"], "inner", spread_by=["object_name"])
    body = body.select("target_id", "baseline_version", (F.col("obj_pos") + 2).alias("line_no"),
                       F.format_string(SNAPSHOT_TABLE, F.col("object_name")).alias("line"))
    counts = objs.groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    heads = versions.join(counts, "target_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    fixed = heads.select("target_id", "baseline_version", F.explode(F.array(
        F.struct(F.lit(1).cast("long").alias("line_no"),
                 F.format_string(SNAPSHOT_HEADER, F.col("baseline_version")).alias("line")),
        F.struct(F.lit(2).cast("long").alias("line_no"), F.lit(SNAPSHOT_TABLES).alias("line")),
        F.struct((F.col("n") + 3).cast("long").alias("line_no"), F.lit(SNAPSHOT_MARKER).alias("line")),
        F.struct((F.col("n") + 4).cast("long").alias("line_no"),
                 F.format_string(SNAPSHOT_FOOTER, F.col("baseline_version")).alias("line")))).alias("l"))
    fixed = fixed.select("target_id", "baseline_version", "l.line_no", "l.line")
    return body.unionByName(fixed)


def write_snapshot(lines: DataFrame, path: str, baseline: int) -> str:
    """S10 sink: the lines of one baseline under a folder of its own; an
    earlier baseline's snapshot stays, and writing one twice is an error.  The
    files are ranges of (target_id, line_no): as many as there are tasks and not
    as there are targets, a large target spreads over several, and a reader of
    one target skips the others by the files' statistics (``read_snapshot``)."""
    out = f"{path.rstrip('/')}/baseline={baseline}"
    (lines.where(F.col("baseline_version") == baseline)
     .repartitionByRange("target_id", "line_no").sortWithinPartitions("target_id", "line_no")
     .write.mode("errorifexists").parquet(out))
    return out


def read_snapshot(spark: SparkSession, path: str, baseline: int, target: str | None = None) -> DataFrame:
    """The lines of one baseline, of one target where given; order by
    (target_id, line_no)."""
    lines = spark.read.parquet(f"{path.rstrip('/')}/baseline={baseline}")
    return lines if target is None else lines.where(F.col("target_id") == target)


def ddl_objects(scripts: DataFrame) -> DataFrame:
    """P20 in one pass over the text: every (target_id, doc_id, keyword,
    object_name) named after CREATE TABLE / DROP TABLE / CREATE INDEX."""
    def tag(alias):   # one-argument lambda: a second one would be the element index
        return lambda x: F.struct(F.lit(alias).alias("keyword"), x.alias("object_name"))

    tagged = [F.transform(fs.extract_objects("body", kw), tag(alias)) for alias, kw in fs.DDL_KEYWORDS.items()]
    return (scripts.select("target_id", "doc_id", F.explode(F.concat(*tagged)).alias("o"))
            .select("target_id", "doc_id", "o.keyword", "o.object_name"))


def objects(scripts: DataFrame, keyword: str) -> DataFrame:
    """P20 + T4: distinct (target_id, object_name) named after a DDL keyword
    anywhere in the scripts' text.  ``scripts`` is either the corpus (with
    ``body``) or its ``ddl_objects``."""
    if "body" in scripts.columns:
        scripts = ddl_objects(scripts)
    alias = {kw: a for a, kw in fs.DDL_KEYWORDS.items()}[keyword]
    return scripts.where(F.col("keyword") == alias).select("target_id", "object_name").distinct()


def expected_tables(scripts: DataFrame) -> DataFrame:
    """Tables created and never dropped, per target."""
    return objects(scripts, "CREATE TABLE").subtract(objects(scripts, "DROP TABLE"))


def dropped_again(scripts: DataFrame) -> DataFrame:
    """Tables created and dropped again (skipped by the check)."""
    return objects(scripts, "CREATE TABLE").intersect(objects(scripts, "DROP TABLE"))


def missing_objects(expected: DataFrame, catalog: DataFrame, object_type: str) -> DataFrame:
    """Expected names with no catalog object of that type (lower-cased
    exact name; the reference's regex search also matches name prefixes)."""
    have = (inventory(catalog).where(F.col("object_type") == object_type)
            .select("target_id", F.lower("object_name").alias("object_name")).distinct())
    return expected.join(have, ["target_id", "object_name"], "left_anti")


def schema_check(scripts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per target and object: PRESENT / MISSING tables and indexes, and
    tables created then dropped (SKIPPED)."""
    exp_t = expected_tables(scripts)
    miss_t = missing_objects(exp_t, catalog, "table").withColumn("_miss", F.lit(True))
    tables = (exp_t.join(miss_t, ["target_id", "object_name"], "left")
              .select("target_id", F.lit("table").alias("object_type"), "object_name",
                      F.when(F.col("_miss"), F.lit("MISSING")).otherwise(F.lit("PRESENT")).alias("status")))
    idx = objects(scripts, "CREATE INDEX")
    miss_i = missing_objects(idx, catalog, "index").withColumn("_miss", F.lit(True))
    indexes = (idx.join(miss_i, ["target_id", "object_name"], "left")
               .select("target_id", F.lit("index").alias("object_type"), "object_name",
                       F.when(F.col("_miss"), F.lit("MISSING")).otherwise(F.lit("PRESENT")).alias("status")))
    skipped = dropped_again(scripts).select("target_id", F.lit("table").alias("object_type"), "object_name",
                                            F.lit("SKIPPED_DROPPED").alias("status"))
    return tables.unionByName(indexes).unionByName(skipped)


def drop_tables(catalog: DataFrame, dropped: DataFrame) -> DataFrame:
    """M5: the catalog after DROP TABLE IF EXISTS of the dropped names."""
    gone = dropped.withColumn("object_type", F.lit("table"))
    return catalog.join(gone, ["target_id", "object_type", "object_name"], "left_anti")


def generate_corpus(tables: DataFrame) -> DataFrame:
    """S11 + J14: tables x operations with a running version (tables in
    ``table_pos`` order, five operations each), file name and SQL text; the
    shell's $RANDOM values come from a fixed arithmetic hash of the version.
    ``tables`` has (table_name, table_pos)."""
    ops = F.array(*[F.struct(F.lit(i).alias("op_index"), F.lit(op).alias("op"))
                    for i, op in enumerate(GEN_OPS)])
    x = tables.select("table_name", "table_pos", F.explode(ops).alias("o")).select(
        "table_name", "table_pos", "o.op_index", "o.op")
    x = x.withColumn("version", ((F.col("table_pos") - 1) * len(GEN_OPS) + F.col("op_index") + 1).cast("long"))
    x = x.withColumn("path", F.format_string("%04d_%s_%s.sql", F.col("version"), F.lower("op"), F.col("table_name")))
    r = [seeded_random(F.col("version"), k) for k in range(1, 5)]
    t = F.col("table_name")
    body = (F.when(F.col("op") == "CREATE", F.format_string(GEN_TEMPLATES["CREATE"], t))
            .when(F.col("op") == "INSERT", F.format_string(GEN_TEMPLATES["INSERT"], t, r[0], r[1]))
            .when(F.col("op") == "UPDATE", F.format_string(GEN_TEMPLATES["UPDATE"], t, r[2], r[3] % ID_RANGE))
            .when(F.col("op") == "DELETE", F.format_string(GEN_TEMPLATES["DELETE"], t, r[0] % ID_RANGE))
            .otherwise(F.format_string(GEN_TEMPLATES["DROP"], t)))
    return x.withColumn("body", body)


def seeded_random(version, k: int):
    """A $RANDOM stand-in: a fixed arithmetic hash of (version, k), 0..32767."""
    return F.pmod(version * F.lit(1103515245) + F.lit(12345 * k), F.lit(RANDOM_RANGE))
