"""Registered queries over the script corpus: scans, scalar functions,
filters (S1, S2, S7, P1-P12, P19-P20, F1, F7, A1, A11, O1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as o
from ..functions import scripts as fs
from ..operators import checks as ck
from ..operators.catalog import ddl_objects
from ..operators import corpus as cp
from ..operators.scan import ordinal
from ..session import scratch_path
from ..sources import bindings as b
from ..sources.corpus import read_corpus
from .registry import register


def parsed(spark, d):
    return cp.parse_scripts(b.scripts(spark, d))


@register("script_corpus_scan", o.sql(
    "SELECT doc_id, target_id, path, length(body) AS body_chars FROM scripts "
    "WHERE suffix(path, '.sql') AND path <> '.sql'", "scripts"))
def script_corpus_scan(spark, d):
    """The corpus as (target, file, whole text); files whose extension is
    exactly 'sql'.  Text length stands in for the body in the comparison."""
    s = b.scripts(spark, d)
    return (s.where(F.col("path").endswith(".sql") & (F.col("path") != ".sql"))
            .select("doc_id", "target_id", "path", F.length("body").cast("long").alias("body_chars")))


@register("absent_source_is_empty", o.sql(
    "SELECT target_id, CAST(0 AS BIGINT) AS files FROM targets", "targets"))
def absent_source_is_empty(spark, d):
    """Every target's file count in a folder that does not exist: the
    reader returns an empty, typed corpus, not an error."""
    missing = read_corpus(spark, scratch_path(spark, "absent"))
    files = missing.groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    return (b.targets(spark, d).join(files, "target_id", "left")
            .select("target_id", F.coalesce("n", F.lit(0)).cast("long").alias("files")))


@register("classify_filename", o.sql(
    "SELECT doc_id, target_id, path, kind FROM parsed_k", "parsed_k"))
def classify_filename(spark, d):
    """P1."""
    return b.scripts(spark, d).select("doc_id", "target_id", "path",
                                      fs.migration_kind("path").alias("kind"))


@register("extract_version", o.sql(
    "SELECT doc_id, vnum AS version FROM parsed_k", "parsed_k"))
def extract_version(spark, d):
    """P2."""
    s = b.scripts(spark, d)
    fname = F.col("path")
    return s.select("doc_id", fs.migration_version(fname, fs.migration_kind(fname)).alias("version"))


@register("extract_name", o.sql("SELECT doc_id, name FROM parsed_k", "parsed_k"))
def extract_name(spark, d):
    """P3."""
    fname = F.col("path")
    return b.scripts(spark, d).select("doc_id", fs.migration_name(fname, fs.migration_kind(fname)).alias("name"))


@register("canonical_filename", o.sql("SELECT doc_id, filename FROM parsed_k", "parsed_k"))
def canonical_filename(spark, d):
    """P4."""
    return cp.parse_names(b.scripts(spark, d)).select("doc_id", "filename")


@register("identifier", o.sql("SELECT doc_id, identifier FROM parsed_k", "parsed_k"))
def identifier(spark, d):
    """P5."""
    return cp.parse_names(b.scripts(spark, d)).select("doc_id", "identifier")


@register("split_up_down", o.sql(
    "SELECT doc_id, marker_style, length(up_sql) AS up_chars, md5(up_sql) AS up_md5, "
    "length(down_sql) AS down_chars, md5(down_sql) AS down_md5 FROM parsed", "parsed"))
def split_up_down(spark, d):
    """Marker style found, and size + fingerprint of each section."""
    return parsed(spark, d).select(
        "doc_id", "marker_style", F.length("up_sql").cast("long").alias("up_chars"), F.md5("up_sql").alias("up_md5"),
        F.length("down_sql").cast("long").alias("down_chars"), F.md5("down_sql").alias("down_md5"))


@register("has_rollback", o.sql("SELECT doc_id, has_rollback FROM parsed", "parsed"))
def has_rollback(spark, d):
    """P7."""
    return parsed(spark, d).select("doc_id", "has_rollback")


@register("checksum", o.sql("SELECT doc_id, checksum FROM parsed", "parsed"))
def checksum(spark, d):
    """md5 of the Up text."""
    return parsed(spark, d).select("doc_id", "checksum")


@register("line_count", o.sql("SELECT doc_id, line_count FROM parsed", "parsed"))
def line_count(spark, d):
    """P9."""
    return parsed(spark, d).select("doc_id", "line_count")


@register("preview", o.sql(
    f"SELECT doc_id, {o.preview_sql('up_sql')} AS preview, line_count > 3 AS preview_more, "
    "substr(up_sql, 1, 100) AS head100 FROM parsed", "parsed"))
def preview(spark, d):
    """P10."""
    return parsed(spark, d).select("doc_id", fs.preview("up_sql").alias("preview"),
                                   fs.preview_truncated("up_sql").alias("preview_more"),
                                   fs.head_chars("up_sql").alias("head100"))


@register("checksum_prefix", o.sql("SELECT doc_id, substr(checksum, 1, 8) AS checksum8 FROM parsed", "parsed"))
def checksum_prefix(spark, d):
    """P11."""
    return parsed(spark, d).select("doc_id", fs.checksum_prefix("checksum").alias("checksum8"))


@register("split_statements", o.sql(
    f"SELECT doc_id, pos, length(stmt) AS stmt_chars, md5(stmt) AS stmt_md5 FROM ("
    f"SELECT doc_id, unnest(generate_series(1, len(st))) AS pos, unnest(st) AS stmt "
    f"FROM (SELECT doc_id, {o.statements_sql('up_sql')} AS st FROM parsed))", "parsed"))
def split_statements(spark, d):
    """One row per statement with its 1-based position."""
    p = parsed(spark, d).select("doc_id", F.posexplode(fs.statements("up_sql")).alias("pos0", "stmt"))
    return p.select("doc_id", (F.col("pos0") + 1).cast("long").alias("pos"), F.length("stmt").cast("long").alias("stmt_chars"),
                    F.md5("stmt").alias("stmt_md5"))


@register("baseline_filename", o.sql(
    "SELECT target_id, printf('baseline_%04d_%s', min(doc_id) + 100, lower(replace(target_id || ' db', ' ', '_'))) "
    "AS baseline_filename FROM scripts GROUP BY target_id", "scripts"))
def baseline_filename(spark, d):
    """File name of a new baseline per target (description '<target> db')."""
    s = b.scripts(spark, d).groupBy("target_id").agg((F.min("doc_id") + 100).alias("v"))
    return s.select("target_id", fs.baseline_filename(
        F.col("v"), F.concat(F.col("target_id"), F.lit(" db"))).alias("baseline_filename"))


def _objects_sql(keyword: str, alias: str) -> str:
    return (f"SELECT DISTINCT target_id, lower(o) AS object_name, '{alias}' AS keyword FROM "
            f"(SELECT target_id, unnest(regexp_extract_all(body, {o._lit(o.ddl_regex(keyword))}, 1)) AS o "
            f"FROM scripts)")


@register("extract_objects", o.sql(
    " UNION ALL ".join(_objects_sql(k, a) for a, k in fs.DDL_KEYWORDS.items()), "scripts"))
def extract_objects(spark, d):
    """P20: object names after CREATE TABLE / DROP TABLE / CREATE INDEX, over
    the whole file text, per target; one pass over the text."""
    return ddl_objects(b.scripts(spark, d)).select("target_id", "object_name", "keyword").distinct()


@register("filter_kind", o.sql(
    "SELECT doc_id, target_id, kind FROM parsed_k WHERE kind = 'versioned'", "parsed_k"))
def filter_kind(spark, d):
    """F1 (versioned only)."""
    return cp.filter_kind(cp.parse_names(b.scripts(spark, d)), "versioned").select("doc_id", "target_id", "kind")


@register("filter_invalid_names", o.sql(
    "SELECT target_id, path, concat('Skipping file with invalid name format: ', path, "
    "' (expected ''NNNN_name.sql'' or ''R__name.sql'')') AS message FROM parsed_k WHERE kind = 'invalid'",
    "parsed_k"))
def filter_invalid_names(spark, d):
    """F7."""
    return cp.invalid_names(cp.parse_names(b.scripts(spark, d)))


@register("count_by_kind", o.sql(
    "SELECT target_id, count(*) AS sql_files, count(*) FILTER (WHERE kind = 'versioned') AS versioned, "
    "count(*) FILTER (WHERE kind = 'repeatable') AS repeatable, count(*) FILTER (WHERE kind = 'invalid') AS invalid "
    "FROM parsed_k GROUP BY target_id", "parsed_k"))
def count_by_kind(spark, d):
    """A1 + A11 (file count per target)."""
    return ck.count_by_kind(cp.parse_names(b.scripts(spark, d)))


@register("file_count", o.sql("SELECT count(*) AS sql_files FROM scripts WHERE suffix(path, '.sql')", "scripts"))
def file_count(spark, d):
    """Number of .sql files in the whole corpus."""
    return b.scripts(spark, d).where(F.col("path").endswith(".sql")).agg(F.count(F.lit(1)).alias("sql_files"))


@register("corpus_order", o.sql(
    "SELECT target_id, path, row_number() OVER (PARTITION BY target_id ORDER BY kind = 'repeatable', version, "
    "name, path) AS corpus_pos FROM skeys", "skeys"))
def corpus_order(spark, d):
    """O1: load order per target (versioned by version, then repeatable by
    name) as a position column."""
    from . import inputs
    k = inputs.valid_names(spark, d).select("target_id", "path", "kind", "version", "name")
    return ordinal(k, ["target_id"], cp.corpus_order_key(), "corpus_pos").select("target_id", "path", "corpus_pos")
