"""Structured Streaming forms of the ledger fold and the script parser (ST1, ST2).

ST1 keeps the current ledger (L7) up to date from a stream of ledger events.
The fold is a streaming aggregation of running maxima per key, so late events
resolve by (ts, seq) without a watermark: the keyed state is one row per key and a
late event only wins if it is newer.  The current ledger is read from that
state itself, through the state data source at the last committed batch: no change
history is kept or aggregated, a reader's work is one row per key, and a batch
replayed after a failure changes nothing.  ``sink`` also publishes the keys each
batch changed, for readers that want a feed.  Large ledgers keep the state in
RocksDB (``session.cluster_conf``).

ST2 parses script files as they arrive (``readStream.text`` with
``wholetext``) and appends the narrow parsed records.

Sinks and checkpoints live under the shared checkpoint folder; every run
takes a fresh sub-folder unless the caller passes a path to resume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import corpus as cp
from ..operators import ledger_log as ll
from ..session import scratch_path
from ..sources import corpus

EPOCH = "_batch_id"


def _append_batch(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn(EPOCH, F.lit(batch_id).cast("long")).write.mode("append").parquet(path)
    return write


def start_ledger_state_stream(events: DataFrame, key: list[str], checkpoint: str, sink: str | None = None,
                              available_now: bool = True, ts: str = "ts", seq: str = "event_id",
                              ms: str = "ms") -> StreamingQuery:
    """ST1: start the streaming fold of a stream of ledger events (key..., ts,
    seq, op, ms).  Its state is the ledger (``read_ledger_state``)."""
    agg = events.groupBy(*key).agg(*ll.state_aggregates(ts, seq, ms))
    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    w = w.format("noop") if sink is None else w.foreachBatch(_append_batch(sink))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# The fields of the fold's state, in the order of ``state_aggregates``: a maximum
# keeps itself, the value at a maximum is kept with the place it comes from.
_STATE_FIELDS = [("_reset", "decimal(38,0)"), ("_reset_op", "int"), ("_p1", "decimal(38,0)"), ("_reset_ts", None),
                 ("_p2", "decimal(38,0)"), ("_update", "decimal(38,0)"), ("_update_op", "int"), ("_p3", "decimal(38,0)"),
                 ("_update_ms", "bigint"), ("_p4", "decimal(38,0)"), ("_success", "decimal(38,0)"), ("_success_ts", None),
                 ("_p5", "decimal(38,0)")]


def read_ledger_state(spark: SparkSession, checkpoint: str, key: list[str], batch_id: int | None = None) -> DataFrame:
    """The current ledger of ST1's stream, from its keyed state at the last
    committed batch (or at ``batch_id``, as long as the stream keeps it)."""
    reader = spark.read.format("statestore")
    state = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
    kinds = [f.dataType.simpleString() for f in state.schema["value"].dataType.fields]
    if len(kinds) != len(_STATE_FIELDS) or any(want not in (None, own) for (_, want), own in zip(_STATE_FIELDS, kinds)):
        raise ValueError(f"not the state of a ledger stream: {kinds}")
    named = ",".join(f"{name}:{kind}" for (name, _), kind in zip(_STATE_FIELDS, kinds))
    rows = state.select(*[F.col("key").getField(c).alias(c) for c in key], F.col("value").cast(f"struct<{named}>").alias("v"))
    return ll.state_from_aggregates(rows.select(*key, *[F.col("v").getField(c).alias(c) for c in ll.STATE_COLUMNS]), key)


def start_script_ingest_stream(scripts: DataFrame, sink: str, checkpoint: str,
                               available_now: bool = True) -> StreamingQuery:
    """ST2: parse a stream of (target_id, path, body) records (P1-P9) and
    append the narrow parsed records to ``sink``."""
    parsed = cp.script_keys(cp.parse_scripts(scripts))
    w = (parsed.writeStream.outputMode("append").format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def script_file_stream(spark: SparkSession, root: str) -> DataFrame:
    """ST2 source: new ``*.sql`` files under ``root/<target_id>/`` as whole
    texts (pass ``wholetext`` as the argument: the option is overridden)."""
    df = (spark.readStream.option("pathGlobFilter", "*.sql").option("recursiveFileLookup", "true")
          .text(root, wholetext=True))
    target, name = corpus.target_and_name(root)
    return df.select(target.alias("target_id"), name.alias("path"), F.col("value").alias("body"))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table as a file stream (new Parquet files are new rows).  The
    table is a folder of part files or one file; a stream takes no path of a file,
    but a pattern that only this file meets (other tables are not listed)."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return reader.parquet(f"{path[:-1]}[t]" if corpus.folder_state(spark, path)[0] == "file" else path)


def run_to_completion(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def fresh_paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, f"streams/{name}")
    return f"{base}/sink", f"{base}/checkpoint"
