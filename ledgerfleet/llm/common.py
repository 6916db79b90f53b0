"""Helpers shared by the operators of this subpackage.

* ``materialize`` cuts lineage: a frame is written as Parquet under the shared
  folder of ``spark.checkpoint.dir`` and read back, so a lost executor never
  repeats what came before and both sides of a later join read the same rows.
* ``map_batches`` runs an Arrow function over the partitions of a frame.
* ``share`` broadcasts an object of bounded size.  Task functions and shared
  objects travel by value, so executors need no installed copy of this package.
"""

from __future__ import annotations

import pickle
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__package__])

# Upper bound of the bytes of one Arrow batch handed to a Python worker.
ARROW_BATCH_BYTES = 16 << 20
ARROW_BATCH_ROWS = 4000


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and by bytes, so that a
    run of very long texts never meets in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, f"llm-{kind}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with the batches of this session bounded."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast ``value`` (its size must be bounded by the caller); tasks call
    the result to get it."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def sub_batches(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of ``column``
    (a single longer value stands alone)."""
    texts = batch.column(column)
    start, held = 0, 0
    for i in range(batch.num_rows):
        size = len(texts[i].as_buffer()) if texts[i].is_valid else 0
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


# A-Z to a-z and nothing else: contracts lower-case ASCII only.
ASCII_LOWER = {65 + i: 97 + i for i in range(26)}
HAS_UPPER = re.compile(r"[A-Z]")


def ascii_lower(text: str) -> str:
    return text.translate(ASCII_LOWER)
