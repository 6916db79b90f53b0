"""Co-located table layout for repeated reports.

A report reads the corpus and the ledger every time.  When both are kept as
tables bucketed (and sorted) on the same join key with the same bucket count,
the reconciliation join reads matching buckets side by side: no shuffle of
either side.  Ingest (ST2 or a batch parse) writes the narrow parsed keys
once; the ledger is kept in the same layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

JOIN_KEYS = ["target_id", "migration_id"]


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: list[str] = JOIN_KEYS) -> None:
    """Write ``df`` as catalog table ``name`` at ``path`` (the shared
    folder), hash-bucketed and sorted on ``keys``."""
    (df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).format("parquet").saveAsTable(name))


def parsed_keys_table(spark: SparkSession, keys: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """The narrow parsed scripts keyed like the ledger (identifier as
    ``migration_id``), bucketed for co-located reconciliation."""
    save_bucketed(keys.withColumnRenamed("identifier", "migration_id"), name, path, buckets)
    return spark.table(name)
