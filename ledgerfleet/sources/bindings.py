"""Bindings: the driver's tables seen as the engine's relations (FIXTURES B1-B7).

Each binding is a narrow projection of one or two driver tables, so Catalyst
prunes the Parquet scan to the columns it needs and pushes any filter down.
Only ``scripts`` carries text; every other binding is keys and small values.
"""

from __future__ import annotations

from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scripts as fs

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Schemas of the tables that the current run has read (a run starts by
# forgetting them): a table is read several times, its footer once.
_SCHEMAS: ContextVar[dict | None] = ContextVar("schemas_of_this_run", default=None)


def new_run() -> None:
    _SCHEMAS.set({})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path, known = table_path(sf_dir, name), _SCHEMAS.get()
    if known is None:
        return spark.read.parquet(path)
    if path not in known:
        known[path] = spark.read.parquet(path).schema
    return spark.read.schema(known[path]).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --- B1 scripts(doc_id, target_id, path, body) ------------------------------

def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scripts_from(table(spark, sf_dir, "documents"))


def scripts_from(documents: DataFrame) -> DataFrame:
    """B1 over a documents relation (batch or stream)."""
    # some numbers occur twice in a target
    path = """CASE WHEN doc_id % 23 = 0 THEN concat('notes-', doc_id, '.sql')
        WHEN doc_id % 50 = 10 THEN concat('R__views_', doc_id % 3, '.sql')
        WHEN doc_id % 10 = 0 THEN concat('R__', lang, '_', doc_id, '.sql')
        ELSE concat(format_string('%04d', if(doc_id % 29 = 7, floor(doc_id / 400) * 400 + 1, doc_id + 1)), '_', lang, '_',
                    doc_id, '.sql') END"""
    body = r"""CASE WHEN doc_id % 6 = 0 THEN concat('-- +migrate Up\n', text, '\n-- +migrate Down\nDROP TABLE t', doc_id, ';')
        WHEN doc_id % 6 = 1 THEN concat('-- UP\n', text, '\n-- DOWN\nDROP TABLE t', doc_id, ';')
        WHEN doc_id % 6 = 2 THEN concat('-- +goose up\n', text, '\n-- +GOOSE Down\n')
        WHEN doc_id % 6 = 3 THEN concat('-- @@UP@@\nCREATE TABLE IF NOT EXISTS t', doc_id % 50, ' (id INT);\n-- comment\nDROP TABLE t',
            doc_id % 20, ';\nCREATE INDEX IF NOT EXISTS ix', doc_id % 30, ' ON t (id);\n', text,
            '\n-- @@DOWN@@\nDROP TABLE t', doc_id, ';')
        WHEN doc_id % 12 = 4 THEN concat('-- Update of the table\n', text, '\n-- DOWN\nDROP TABLE t', doc_id, ';')
        WHEN doc_id % 6 = 4 THEN concat('-- +migrate Up\n', text)
        ELSE text END"""
    return documents.selectExpr("doc_id", "source AS target_id", f"{path} AS path", f"{body} AS body")


def proposed_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new baseline per target for F5 / R5: the lowest doc id + 150 (runs
    stand in the way); src2 proposes the one it has, src3 a free high one."""
    own = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("target_id")).agg((F.min("doc_id") + 150).alias("_own"))
    return own.select("target_id", F.when(F.col("target_id") == "src2", F.lit(HIGH_BASELINE))
                      .when(F.col("target_id") == "src3", F.lit(60_000_000)).otherwise(F.col("_own")).cast("long")
                      .alias("new_baseline"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target of B1 (no text is read), and one without any script."""
    own = table(spark, sf_dir, "documents").select(F.col("source").alias("target_id")).distinct()
    return own.unionByName(spark.range(1).select(F.lit("idle").alias("target_id")))


# --- B2 ledger (8 columns + target_id) -----------------------------------------

def ledger(spark: SparkSession, sf_dir: str, parsed: DataFrame | None = None) -> DataFrame:
    """Ledger rows for scripts with a valid name that have a label, stamped
    with the event of the same id, plus one baseline row per target.

    The stored checksum is that of the Up section, as the tool would have
    written it; a 'toxic' label stands for a file edited after it was
    applied (its stored checksum is the md5 of the file's checksum plus one
    character: a different checksum, computed without a second pass over the text).
    ``parsed`` may be a narrow parse carrying ``checksum`` and
    ``checksum_edited`` instead of the Up text.
    """
    from ..operators.corpus import parse_scripts
    if parsed is None:
        parsed = parse_scripts(scripts(spark, sf_dir))
    if "checksum_edited" not in parsed.columns:
        parsed = parsed.withColumn("checksum_edited", F.md5(F.concat(F.col("checksum"), F.lit("x"))))
    p = parsed.select("doc_id", "target_id", "path", "checksum", "checksum_edited")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "ts", "value")
    is_rep = F.col("path").startswith("R__")
    rows = (p.where(F.col("doc_id") % 23 != 0)
            .join(labels, "doc_id").join(events, "doc_id")
            .select(
                "target_id",
                F.when(F.col("doc_id") % 19 == 0, F.concat(F.lit("orphan_"), _s("doc_id")))
                 .when(is_rep, F.replace(F.col("path"), F.lit(".sql"), F.lit("")))
                 .otherwise(_s(F.col("doc_id") + 1)).alias("migration_id"),
                F.when(is_rep, F.lit("repeatable")).otherwise(F.lit("versioned")).alias("migration_type"),
                F.when(is_rep, F.lit(None).cast("long")).when(F.col("doc_id") % 19 == 0, F.col("doc_id") + 1_000_001)
                 .otherwise(F.col("doc_id") + 1).alias("version"),
                F.col("path").alias("filename"),
                F.when(F.col("toxic") == 1, F.col("checksum_edited"))
                 .otherwise(F.col("checksum")).alias("checksum"),
                F.col("ts").alias("applied_at"),
                F.floor(F.col("value") * 10).cast("long").alias("execution_time_ms"),
                (F.col("quality") == 1).alias("success")))
    # a failed run one hour before the recorded one: the ledger keeps both rows
    retried = (rows.where(F.coalesce(F.col("version"), F.lit(0)) % 9 == 1)
               .withColumn("applied_at", F.col("applied_at") - F.make_dt_interval(F.lit(0), F.lit(1)))
               .withColumn("success", F.lit(False)))
    return rows.unionByName(retried).unionByName(ledger_baselines(spark, sf_dir))


HIGH_BASELINE = 50_000_000


def ledger_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline rows of B2 (one per target, a second, high one for src2),
    which need no script text."""
    first = table(spark, sf_dir, "documents").groupBy("source").agg((F.min("doc_id") + 100).alias("v"))
    rows = first.unionByName(first.where(F.col("source") == "src2").withColumn("v", F.lit(HIGH_BASELINE).cast("long")))
    return rows.select(
        F.col("source").alias("target_id"), _s("v").alias("migration_id"), F.lit("baseline").alias("migration_type"),
        F.col("v").alias("version"), F.concat(F.lit("baseline_"), F.col("source")).alias("filename"),
        F.lit("baseline").alias("checksum"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("applied_at"),
        F.lit(0).cast("long").alias("execution_time_ms"), F.lit(True).alias("success"))


# --- B3 seq(target_id, version) ---------------------------------------------------

def seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    keep = c.where((F.col("conv_id") * 7 + F.col("turn")) % 11 != 0)
    dup = c.where((F.col("conv_id") + F.col("turn")) % 13 == 0)
    cols = [F.col("conv_id").alias("target_id"), (F.col("turn") + 1).alias("version")]
    return keep.select(*cols).unionAll(dup.select(*cols))


# --- B4 ledger_log --------------------------------------------------------------------

LOG_OPS = {"purchase": "success", "error": "failure", "view": "remove"}  # else 'start'


def ledger_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    op = F.lit("start")
    for et, o in reversed(list(LOG_OPS.items())):
        op = F.when(F.col("event_type") == et, F.lit(o)).otherwise(op)
    return e.select(F.col("user_id").alias("target_id"), (F.col("event_id") % 40).alias("version"),
                    "event_id", "ts", op.alias("op"), F.floor(F.col("value") * 10).cast("int").alias("ms"))


# --- B5 changes ----------------------------------------------------------------------

CHANGE_TARGETS = 50


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row changes of 50 targets.  Updates and deletes go to keys of the
    target's own base rows (``order_rows``) or beside them; inserts bring new
    keys, but every tenth of an odd target's may meet a row.  Some values of
    every fourth target are NULL."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    op = (F.when(F.col("event_type") == "error", F.lit("delete"))
          .when(F.col("event_type") == "signup", F.lit("insert")).otherwise(F.lit("update")))
    target = F.col("user_id") % CHANGE_TARGETS
    own = (F.col("user_id") * 7) % 300 * CHANGE_TARGETS + target
    fresh = F.lit(100_000_000) + F.col("event_id") * CHANGE_TARGETS + target
    key = F.when((op == "insert") & ((target % 2 == 0) | (F.col("event_id") % 10 != 5)), fresh).otherwise(own)
    value = F.when((target % 4 == 3) & (F.col("event_id") % 101 == 3), F.lit(None)).otherwise(F.col("value"))
    return e.select(target.cast("long").alias("target_id"), (F.col("event_id") + 1).alias("version"),
                    key.cast("long").alias("o_orderkey"), op.alias("op"), value.cast("double").alias("value"))


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders tables of the 50 targets as one relation: two targets may
    hold the same key, so each order is a row of its own target and, every
    seventh, of the next one too."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    o = table(spark, sf_dir, "orders").select(*cols)
    own = F.col("o_orderkey") % CHANGE_TARGETS
    both = F.when(F.col("o_orderkey") % 7 == 0, F.array(own, (own + 1) % CHANGE_TARGETS)).otherwise(F.array(own))
    return o.select(F.explode(both).alias("target_id"), *cols).withColumn("target_id", F.col("target_id").cast("long"))


def change_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scripts behind B5's changes: one per change, some without a Down
    section (every 211th), some without a file (every 499th)."""
    c = changes(spark, sf_dir).select("target_id", "version")
    return c.where(F.col("version") % 499 != 0).select(
        "target_id", "version", F.lit("versioned").alias("kind"), F.format_string("%04d_change.sql", "version").alias("path"),
        (F.col("version") % 211 != 0).alias("has_rollback"))


def gated_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of B5 whose script numbers have a gap or a double (B3's
    sequences, each standing for every third target)."""
    from ..operators.checks import version_positions
    issues = version_positions(seq(spark, sf_dir)).where("is_gap").select("target_id").distinct()
    return (issues.select((F.col("target_id") * 3).cast("long").alias("target_id"))
            .where(F.col("target_id") < CHANGE_TARGETS))


# --- B6 conns(conn_id, conn) -------------------------------------------------------------

CONN_FORMS = [
    "Driver=x; Host=h{key}; HTTPPath=/sql; AuthMech=3; PWD=p", "Driver=x;Host=h;HTTPPath=/s;AuthMech=11",
    "postgresql://u@h/{brand}", "Driver=MySQL ODBC;Server=s", "dsn={type}", "sqlite:///data/{key}.db",
    "Driver=psqlODBC;Server=mysqlhost{key}", "postgresql://h/mysql_{key}", "Driver=SQLite3;Database=d",
    "Driver=x;Host=h", "Host=h;HTTPPath=/s", "Driver=x;Host=h;HTTPPath=/s", "Driver=x;Host=h;HTTPPath=/s;AuthMech=3",
    "Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=0", "Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=1;Auth_Client_ID=c",
    "Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=2", "Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=9{key}",
    "Driver=x;Host=h;HTTPPath=/s;AuthMech=7", "Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=2;PWD=p;PWD=q=r",
    "Driver=x;Host=h;HTTPPath=/s;AuthMech=11;Auth_Flow=0;Auth_AccessToken=t", "pg", "mariadb", "sqlite3", "delta", "unknown"]


def conns(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    forms = F.array(*[F.lit(x) for x in CONN_FORMS])
    form = F.element_at(forms, (F.col("p_partkey") % len(CONN_FORMS) + 1).cast("int"))
    conn = F.replace(F.replace(F.replace(form, F.lit("{key}"), _s("p_partkey")), F.lit("{brand}"), F.col("p_brand")),
                     F.lit("{type}"), F.col("p_type"))
    return p.select(F.col("p_partkey").alias("conn_id"), conn.alias("conn"))


# --- B7 catalog snapshot -------------------------------------------------------------------

def catalog(spark: SparkSession, sf_dir: str, sc: DataFrame | None = None) -> DataFrame:
    """Objects a target's database reports, with dialect and schema: the
    tables and indexes created by four out of five of its scripts, the ledger
    table, user tables whose names look like system ones, a view, a sequence
    and a temporary view per language, and system objects.  Derived from the
    corpus so it grows with it."""
    sc = sc if sc is not None else scripts(spark, sf_dir)
    if "body" in sc.columns:   # raw corpus: extract the DDL names here
        from ..operators.catalog import ddl_objects
        sc = ddl_objects(sc)
    made = sc.where((F.col("doc_id") % 5 != 0) & F.col("keyword").isin("create_table", "create_index"))
    created = made.select("target_id", F.lit("public").alias("schema_name"),
                          F.when(F.col("keyword") == "create_index", F.lit("index")).otherwise(F.lit("table"))
                          .alias("object_type"), "object_name", F.lit(False).alias("is_temporary"))
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("target_id"), "lang").distinct()

    def each(schema: str, kind: str, name, temporary: bool):
        return F.struct(F.lit(schema).alias("schema_name"), F.lit(kind).alias("object_type"), name.alias("object_name"),
                        F.lit(temporary).alias("is_temporary"))

    fixed = F.array(
        each("public", "table", F.lit("schema_migrations"), False), each("public", "table", F.lit("pg_archive"), False),
        each("public", "table", F.lit("sqlite_stat1"), False), each("pg_catalog", "table", F.lit("pg_class"), False),
        each("information_schema", "view", F.lit("tables"), False), each("mysql", "table", F.lit("user"), False),
        each("public", "view", F.concat(F.lit("v_"), F.col("lang")), False),
        each("public", "sequence", F.concat(F.lit("seq_"), F.col("lang")), False),
        each("public", "view", F.concat(F.lit("tmp_"), F.col("lang")), True))
    others = docs.select("target_id", F.explode(fixed).alias("o")).select("target_id", "o.*")
    k = F.pmod(F.length("target_id"), F.lit(3))
    dialect = F.when(k == 0, F.lit("MySQL")).when(k == 1, F.lit("SQLite")).otherwise(F.lit("PostgreSQL"))
    return (created.unionByName(others).distinct()
            .select("target_id", dialect.alias("dialect"), "schema_name", "object_type", "object_name", "is_temporary"))
