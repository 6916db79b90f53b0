"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it under the shared checkpoint folder and reads it back as the next stage's
documents.  All stages but the last return the columns of ``documents``.

1. quality: documents the byte-level network scores below 0.3 go.
2. near_dedup: of each SimHash component the smallest doc_id stays.
3. decontamination: documents with a twentieth of their words inside windows
   of benchmark items go.
4. pii: personal spans are replaced by their kind in brackets; ``n_chars``
   follows the text.
5. packing: what is left, tokenized and packed into sequences of 4096 tokens;
   one row per piece.

Null texts count as empty throughout and stay null until they are packed.  A
table without rows runs through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfleet.llm import decontam, packing, pii, quality, queries, simhash
from ledgerfleet.llm.common import materialize, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, queries.quality_net(spark, docs, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each_group(docs).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redacted(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(kind)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# A convolutional network, SimHash trees and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
