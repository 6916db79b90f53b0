"""Script corpus parsing: one narrow record per script.

The text columns are read once, in the scan stage; everything that follows
(joins, windows, aggregates) carries only keys, a checksum and small numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scripts as fs

# Columns every downstream operator needs; no script text.
KEY_COLUMNS = ["target_id", "path", "kind", "version", "name", "filename", "identifier",
               "checksum", "has_rollback", "line_count"]


# What the file name alone tells.
NAME_COLUMNS = ["target_id", "path", "kind", "version", "name", "filename", "identifier"]


def parse_names(corpus: DataFrame) -> DataFrame:
    """Add kind/version/name/canonical filename/identifier."""
    fname = F.col("path")  # the file name; sources hand over base names
    df = corpus.withColumn("kind", fs.migration_kind(fname))
    df = (df.withColumn("version", fs.migration_version(fname, "kind"))
            .withColumn("name", fs.migration_name(fname, "kind")))
    return (df.withColumn("filename", fs.canonical_filename("kind", "version", "name"))
              .withColumn("identifier", fs.migration_identifier("kind", "version", "name")))


def parse_scripts(corpus: DataFrame, checksum_algo: str = "md5") -> DataFrame:
    """``parse_names``, and the Up/Down split (P6), has_rollback (P7), checksum
    of the Up text (P8) and the Up line count (P9) of a corpus of (target_id,
    path, body)."""
    df = fs.split_sections(parse_names(corpus), "body")
    return (df.withColumn("has_rollback", fs.has_rollback("down_sql"))
              .withColumn("checksum", fs.checksum("up_sql", checksum_algo))
              .withColumn("line_count", fs.line_count("up_sql")))


def valid_scripts(parsed: DataFrame) -> DataFrame:
    """F1/F7 complement: scripts the loader keeps (versioned or repeatable)."""
    return parsed.where(F.col("kind") != "invalid")


def script_keys(parsed: DataFrame) -> DataFrame:
    """Valid scripts, projected to the narrow key columns."""
    cols = [c for c in KEY_COLUMNS if c in parsed.columns]
    extra = [c for c in ("doc_id",) if c in parsed.columns]
    return valid_scripts(parsed).select(*extra, *cols)


def invalid_names(parsed: DataFrame) -> DataFrame:
    """files matching neither naming rule, as a reject table."""
    return (parsed.where(F.col("kind") == "invalid")
            .select("target_id", "path",
                    F.format_string("Skipping file with invalid name format: %s "
                                    "(expected 'NNNN_name.sql' or 'R__name.sql')",
                                    F.col("path")).alias("message")))


def filter_kind(parsed: DataFrame, kind: str) -> DataFrame:
    """versioned only / repeatable only."""
    return parsed.where(F.col("kind") == kind)


def corpus_order_key(kind="kind", version="version", name="name", path="path"):
    """O1: versioned by version, then repeatable by name (path breaks ties)."""
    return [F.col(kind) == "repeatable", F.col(version), F.col(name), F.col(path)]
