"""Ledger as a source: typed scan, text form, and the simple ledger filters
(S3, S4, S6, F2, F5, F6, A3 list, O2, O5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode as dc
from ..model import LEDGER_SCHEMA, LEDGER_TABLE
from ..operators.joins import per_target_join
from ..operators.scan import freeze, ordinal


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """S3: a Parquet ledger with the fixed schema (never inferred)."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def create_ledger_table(spark: SparkSession, location: str, name: str = LEDGER_TABLE) -> None:
    """Create the ledger table if missing, with its defaults.  Parquet
    tables take no PRIMARY KEY and do not enforce NOT NULL; uniqueness and
    nullability are the M10 / M11 data checks instead."""
    spark.sql(f"""
      CREATE TABLE IF NOT EXISTS {name} (
        target_id STRING NOT NULL, migration_id STRING NOT NULL,
        migration_type STRING NOT NULL DEFAULT 'versioned', version BIGINT,
        filename STRING NOT NULL, checksum STRING NOT NULL,
        applied_at TIMESTAMP_NTZ DEFAULT localtimestamp(), execution_time_ms BIGINT NOT NULL DEFAULT 0,
        success BOOLEAN NOT NULL DEFAULT false)
      USING parquet LOCATION '{location}'""")


def rows_as_text(df: DataFrame) -> DataFrame:
    """Every cell as text, SQL NULL as the text 'NULL'."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(c) for c in df.columns])


def ledger_as_text(ledger: DataFrame) -> DataFrame:
    return rows_as_text(ledger)


def decode_ledger(text: DataFrame) -> DataFrame:
    """S3 from text cells: version NULL for repeatables and 0 when unreadable,
    timestamps by P13, counts by P15, success by P14 (SURVEY Q14, Q15)."""
    t = F.col("migration_type")
    return text.select(
        "target_id", "migration_id", "migration_type",
        F.when(t == "repeatable", F.lit(None).cast("long")).otherwise(dc.decode_int_or_zero("version")).alias("version"),
        "filename", "checksum",
        dc.decode_timestamp("applied_at").alias("applied_at"),
        dc.decode_int_or_zero("execution_time_ms", dc.I32_MIN, dc.I32_MAX).alias("execution_time_ms"),
        dc.decode_boolean("success").alias("success"))


def rollbackable(ledger: DataFrame) -> DataFrame:
    """successful versioned rows (baselines are never rolled back, Q12)."""
    return ledger.where((F.col("migration_type") == "versioned") & F.col("success"))


def above_target(ledger: DataFrame, target_version: int) -> DataFrame:
    """Rows strictly above the rollback target (Q20)."""
    return ledger.where(F.col("version") > F.lit(target_version))


def conflicting(ledger: DataFrame, proposals: DataFrame) -> DataFrame:
    """ledger rows at or above a proposed baseline; ``proposals`` holds
    (target_id, new_baseline), one row per target."""
    return (per_target_join(ledger, proposals, ["target_id"], "inner", spread_by=["migration_id"])
            .where(F.col("version") >= F.col("new_baseline")))


def applied_versions(ledger: DataFrame) -> DataFrame:
    """A3: the ordered list of successfully applied versions, as rows with a
    position; the highest position holds the latest version."""
    v = rollbackable(ledger).select("target_id", "version").distinct()
    return ordinal(freeze(v), ["target_id"], [F.col("version")], "pos").select("target_id", "version", "pos")


def ledger_order_key():
    """O2: versioned rows first by version, all others by file name."""
    is_v = F.col("migration_type") == "versioned"
    return [F.when(is_v, F.lit(0)).otherwise(F.lit(1)), F.when(is_v, F.col("version")).otherwise(F.lit(0)),
            F.col("filename"), F.col("migration_id")]
