"""The ledger as an append-only event log and its current state (L1-L7, W6,
W8, A12, J12, M6, O6).

The reference keeps one mutable row per migration and changes it in place:
``start`` inserts (a repeatable first deletes its old row), ``success`` and
``failure`` update, ``remove`` deletes.  Here every change is an event and the
current ledger is a fold of the events per key:

* the row exists when the key's last ``start``/``remove`` event is a start;
* its state comes from the last ``success``/``failure`` event after that
  start (none: success = false, 0 ms, applied_at = the start time);
* ``failure`` keeps applied_at (from the start or an earlier success).

"The last update after the live start" is "the last update overall, if it
comes after the last start/remove", so the whole fold is one grouped
aggregation -- map-side partial aggregation, no join, no per-key sort, and the
same aggregation runs in a stream (ST1).  The order (time, sequence) is one
decimal and operations are small numbers: every buffer has a fixed width, so
Spark aggregates in a hash table instead of sorting the log.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import per_target_join
from .scan import last_before, ordinal

RESET_OPS = ("start", "remove")
UPDATE_OPS = ("success", "failure")


OPS = ("start", "success", "failure", "remove")


def _after(ts, eid, ts0, eid0):
    return (F.col(ts) > F.col(ts0)) | ((F.col(ts) == F.col(ts0)) & (F.col(eid) > F.col(eid0)))


def event_order(ts: str, seq: str):
    """(ts, seq) as one decimal: microseconds since 1970 times 10**19 plus the
    sequence number (both of any size a timestamp and a long can have)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    return (micros.cast("decimal(18,0)") * F.lit(Decimal(10 ** 19)).cast("decimal(20,0)")).cast("decimal(38,0)") \
        + F.col(seq).cast("decimal(19,0)")


def op_code(op="op"):
    """Operations as numbers (their place in OPS)."""
    code = F.lit(None).cast("int")
    for k, name in enumerate(OPS):
        code = F.when(F.col(op) == name, F.lit(k)).otherwise(code)
    return code


def op_name(code):
    """The operation of a number."""
    name = F.lit(None).cast("string")
    for k, own in enumerate(OPS):
        name = F.when(code == k, F.lit(own)).otherwise(name)
    return name


def latest_event(log: DataFrame, key: list[str], ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """The last event per key by (ts, seq) -- one current row per id."""
    order = event_order(ts, seq)
    others = [c for c in log.columns if c not in key]
    last = [F.max_by(op_code(c) if c == "op" else F.col(c), order).alias(c) for c in others]
    out = log.groupBy(*key).agg(*last)
    return out.withColumn("op", op_name(F.col("op"))) if "op" in others else out


def state_aggregates(ts: str = "ts", seq: str = "event_id", ms: str = "ms") -> list:
    """The running maxima the fold needs: place, operation and time of the last
    reset (start/remove), place, operation and duration of the last update
    (success/failure), place and time of the last success."""
    op, order, code = F.col("op"), event_order(ts, seq), op_code()
    reset = F.when(op.isin(*RESET_OPS), order)
    update = F.when(op.isin(*UPDATE_OPS), order)
    success = F.when(op == "success", order)
    return [F.max(reset).alias("_reset"), F.max_by(code, reset).alias("_reset_op"), F.max_by(F.col(ts), reset).alias("_reset_ts"),
            F.max(update).alias("_update"), F.max_by(code, update).alias("_update_op"),
            F.max_by(F.col(ms).cast("long"), update).alias("_update_ms"),
            F.max(success).alias("_success"), F.max_by(F.col(ts), success).alias("_success_ts")]


STATE_COLUMNS = ["_reset", "_reset_op", "_reset_ts", "_update", "_update_op", "_update_ms", "_success", "_success_ts"]


def state_from_aggregates(agg, key: list[str]):
    """Current row per key from ``state_aggregates``: the key exists when
    its last reset is a start; an update counts when it comes after it."""
    u_after = F.coalesce(F.col("_update") > F.col("_reset"), F.lit(False))
    s_after = F.coalesce(F.col("_success") > F.col("_reset"), F.lit(False))
    start, success = OPS.index("start"), OPS.index("success")
    return agg.where(F.col("_reset_op") == start).select(
        *key,
        F.when(s_after, F.col("_success_ts")).otherwise(F.col("_reset_ts")).alias("applied_at"),
        F.when(u_after, F.col("_update_ms")).otherwise(F.lit(0).cast("long")).alias("execution_time_ms"),
        (u_after & (F.col("_update_op") == success)).alias("success"),
        op_name(F.when(u_after, F.col("_update_op")).otherwise(F.lit(start))).alias("last_op"))


def ledger_state(log: DataFrame, key: list[str], ts: str = "ts", seq: str = "event_id",
                 ms: str = "ms") -> DataFrame:
    """The current ledger row per key from the event log (see module
    doc): one grouped aggregation with map-side partial aggregation, so a
    hot key never lands whole in one task.  Returns key + applied_at,
    execution_time_ms, success, last_op."""
    agg = log.groupBy(*key).agg(*state_aggregates(ts, seq, ms))
    return state_from_aggregates(agg, key)


def record_start(log: DataFrame, key: list[str], ts: str = "ts") -> DataFrame:
    """L1: the ledger row a start writes: success false, 0 ms, stamped now."""
    return log.where(F.col("op") == "start").select(
        *key, F.col(ts).alias("applied_at"), F.lit(0).cast("long").alias("execution_time_ms"),
        F.lit(False).alias("success"))


def _with_live(log: DataFrame, key: list[str], ts: str, seq: str) -> DataFrame:
    """Add ``_live`` (the key has a row before this event: its last start or
    remove is a start) and ``_kept`` (the time that row bears)."""
    marked = (log.withColumn("_reset", F.when(F.col("op").isin(*RESET_OPS), F.col("op")))
              .withColumn("_stamp", F.when(F.col("op").isin("start", "success"), F.col(ts))))
    prev = last_before(marked, key, [F.col(ts), F.col(seq)], ["_reset", "_stamp"], ["_before", "_kept"])
    return prev.withColumn("_live", F.coalesce(F.col("_before") == "start", F.lit(False)))


def record_success(log: DataFrame, key: list[str], ts: str = "ts", seq: str = "event_id", ms: str = "ms") -> DataFrame:
    """L2: the row after a success: its time, success, its timestamp.  A
    success of a key without a row updates nothing."""
    return _with_live(log, key, ts, seq).where((F.col("op") == "success") & F.col("_live")).select(
        *key, F.col(ts).alias("applied_at"), F.col(ms).cast("long").alias("execution_time_ms"),
        F.lit(True).alias("success"))


def record_failure(log: DataFrame, key: list[str], ts: str = "ts", seq: str = "event_id",
                   ms: str = "ms") -> DataFrame:
    """L3: the row after a failure: its duration, success false, applied_at
    kept from the live row's start or latest success.  A failure of a key
    without a row (never started, or removed since) updates nothing."""
    return _with_live(log, key, ts, seq).where((F.col("op") == "failure") & F.col("_live")).select(
        *key, seq, F.col("_kept").alias("applied_at"), F.col(ms).cast("long").alias("execution_time_ms"),
        F.lit(False).alias("success"))


def removed_keys(log: DataFrame, key: list[str], ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """L4: keys whose row the log has deleted (last start/remove is remove)."""
    return (log.where(F.col("op").isin(*RESET_OPS)).groupBy(*key)
            .agg(F.max_by(op_code(), event_order(ts, seq)).alias("op"))
            .where(F.col("op") == OPS.index("remove")).select(*key))


def blocked_after_failure(log: DataFrame, group: list[str], ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Flag rows that come after the group's first failure (nothing after
    the first failure is attempted, SURVEY Q25)."""
    first = (log.where(F.col("op") == "failure").groupBy(*group)
             .agg(F.min(F.struct(F.col(ts).alias("f_ts"), F.col(seq).alias("f_seq"))).alias("f"))
             .select(*group, "f.f_ts", "f.f_seq"))
    j = per_target_join(log, first, group, "left", spread_by=[seq])
    blocked = F.coalesce(_after(ts, seq, "f_ts", "f_seq"), F.lit(False))
    return j.withColumn("blocked", blocked).drop("f_ts", "f_seq")


def execution_count(log: DataFrame, key: list[str]) -> DataFrame:
    """Number of executions (start events) per script."""
    return log.where(F.col("op") == "start").groupBy(*key).agg(F.count(F.lit(1)).alias("execution_count"))


def bump_counts(existing: DataFrame, run: DataFrame, key: list[str]) -> DataFrame:
    """J12 + M6: the scripts of a run read their previous count (left join)
    and upsert count + 1 (or 1); other rows stay.  ``existing`` has key +
    execution_count, ``run`` has the distinct keys that ran."""
    ran = run.select(*key).distinct().withColumn("_ran", F.lit(True))
    j = existing.join(ran, key, "full_outer")
    return j.select(*key, F.when(F.col("_ran"), F.coalesce(F.col("execution_count") + 1, F.lit(1)))
                    .otherwise(F.col("execution_count")).cast("long").alias("execution_count"),
                    F.coalesce("_ran", F.lit(False)).alias("updated"))


def newest_first(log: DataFrame, group: list[str], ts: str = "ts", seq: str = "event_id") -> DataFrame:
    """Position of each log row per group, newest first."""
    return ordinal(log, group, [F.col(ts).desc(), F.col(seq).desc()], "recent_pos")
