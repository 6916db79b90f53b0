"""Registered streaming queries (ST1, ST2): each runs its stream over the
driver table with ``availableNow`` into a fresh folder under the shared
checkpoint folder and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as o
from ..sources import bindings as b
from ..streaming import streams as st
from .q_ledger import _STATE_LOCAL
from .registry import register

KEY = ["target_id", "version"]


def _log_stream(spark, d):
    e = st.table_stream(spark, d, "events")
    op = F.lit("start")
    for et, x in reversed(list(b.LOG_OPS.items())):
        op = F.when(F.col("event_type") == et, F.lit(x)).otherwise(op)
    return e.select(F.col("user_id").alias("target_id"), (F.col("event_id") % 40).alias("version"),
                    "event_id", "ts", op.alias("op"), F.floor(F.col("value") * 10).cast("int").alias("ms"))


@register("ledger_state_stream", o.sql(
    "SELECT l.target_id, l.version, coalesce(s.success_ts, l.t0) AS applied_at, "
    "coalesce(CAST(u.ms AS BIGINT), 0) AS execution_time_ms, coalesce(u.op = 'success', false) AS success, "
    "coalesce(u.op, 'start') AS last_op FROM live l "
    "LEFT JOIN lastu u ON u.target_id = l.target_id AND u.version = l.version "
    "LEFT JOIN succ s ON s.target_id = l.target_id AND s.version = l.version", "ledger_log", local=_STATE_LOCAL))
def ledger_state_stream(spark, d):
    """ST1: the L7 fold as a streaming aggregation over the events file, read
    from its keyed state."""
    _, ck = st.fresh_paths(spark, "ledger_state")
    st.run_to_completion(st.start_ledger_state_stream(_log_stream(spark, d), KEY, ck))
    return st.read_ledger_state(spark, ck, KEY)


@register("script_ingest_stream", o.sql(
    "SELECT doc_id, target_id, path, kind, version, name, filename, identifier, checksum, has_rollback, line_count "
    "FROM skeys", "skeys"))
def script_ingest_stream(spark, d):
    """ST2: scripts parsed as they arrive (the documents file as a stream)."""
    docs = st.table_stream(spark, d, "documents")
    scripts = b.scripts_from(docs)
    sink, ck = st.fresh_paths(spark, "script_ingest")
    st.run_to_completion(st.start_script_ingest_stream(scripts, sink, ck))
    return spark.read.parquet(sink)
