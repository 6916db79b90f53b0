"""Registered queries: ledger event log, rollback and baseline (L1-L7, W4-W8,
O2, O4-O6, A12, J6, J12, M6, R4, R5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as o
from ..operators import ledger_log as ll
from ..operators import reconcile as rc
from ..operators import rollback as rb
from ..operators.scan import freeze, ordinal
from ..sources import bindings as b
from ..sources import ledger as lg
from .q_reconcile import keys, ledger, ledger_names
from . import inputs
from .registry import register

KEY = ["target_id", "version"]
CUTOFF = "2024-01-08 00:00:00"     # history before it, the current run after it
STEPS = 3                          # rollback Steps(n)
TO_VERSION = 500                   # rollback ToVersion(t)
SUMMARY_TO_VERSION = 900           # ToVersion used by the verdict query
BASELINE_DESCRIPTION = "initial schema"
BASELINE_AT = "2024-06-01 00:00:00"


def log(spark, d):
    return b.ledger_log(spark, d)


_LAST = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {p} ORDER BY ts DESC, event_id DESC) AS rn "
         "FROM {t}) WHERE rn = 1")


@register("latest_ledger_row", o.sql(
    "SELECT target_id, version, event_id, ts, op, ms FROM (" + _LAST.format(p="target_id, version", t="ledger_log")
    + ")", "ledger_log"))
def latest_ledger_row(spark, d):
    """The last event per (target, version) by (ts, event_id)."""
    return ll.latest_event(log(spark, d), KEY).select("target_id", "version", "event_id", "ts", "op", "ms")


_STATE_LOCAL = [
    ("resets", "SELECT target_id, version, op, ts AS t0, event_id AS s0 FROM ("
     + _LAST.format(p="target_id, version", t="(SELECT * FROM ledger_log WHERE op IN ('start', 'remove'))") + ")"),
    ("live", "SELECT target_id, version, t0, s0 FROM resets WHERE op = 'start'"),
    ("upd", "SELECT e.target_id, e.version, e.ts, e.event_id, e.op, e.ms FROM ledger_log e JOIN live l "
     "ON e.target_id = l.target_id AND e.version = l.version WHERE e.op IN ('success', 'failure') "
     "AND (e.ts > l.t0 OR (e.ts = l.t0 AND e.event_id > l.s0))"),
    ("lastu", _LAST.format(p="target_id, version", t="upd")),
    ("succ", "SELECT target_id, version, max(ts) AS success_ts FROM upd WHERE op = 'success' "
     "GROUP BY target_id, version"),
]


@register("ledger_state", o.sql(
    "SELECT l.target_id, l.version, coalesce(s.success_ts, l.t0) AS applied_at, "
    "coalesce(CAST(u.ms AS BIGINT), 0) AS execution_time_ms, coalesce(u.op = 'success', false) AS success, "
    "coalesce(u.op, 'start') AS last_op FROM live l "
    "LEFT JOIN lastu u ON u.target_id = l.target_id AND u.version = l.version "
    "LEFT JOIN succ s ON s.target_id = l.target_id AND s.version = l.version", "ledger_log", local=_STATE_LOCAL))
def ledger_state(spark, d):
    """The current ledger per (target, version) folded from the log."""
    return ll.ledger_state(log(spark, d), KEY)


@register("record_start", o.sql(
    "SELECT target_id, version, ts AS applied_at, CAST(0 AS BIGINT) AS execution_time_ms, false AS success "
    "FROM ledger_log WHERE op = 'start'", "ledger_log"))
def record_start(spark, d):
    """L1."""
    return ll.record_start(log(spark, d), KEY)


_LIVED = [("lived", "SELECT *, last_value(CASE WHEN op IN ('start', 'remove') THEN op END IGNORE NULLS) OVER w AS before, "
           "last_value(CASE WHEN op IN ('start', 'success') THEN ts END IGNORE NULLS) OVER w AS kept FROM ledger_log "
           "WINDOW w AS (PARTITION BY target_id, version ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING "
           "AND 1 PRECEDING)")]


@register("record_success", o.sql(
    "SELECT target_id, version, ts AS applied_at, CAST(ms AS BIGINT) AS execution_time_ms, true AS success "
    "FROM lived WHERE op = 'success' AND before = 'start'", "ledger_log", local=_LIVED))
def record_success(spark, d):
    """L2."""
    return ll.record_success(log(spark, d), KEY)


@register("record_failure", o.sql(
    "SELECT target_id, version, event_id, kept AS applied_at, CAST(ms AS BIGINT) AS execution_time_ms, false AS success "
    "FROM lived WHERE op = 'failure' AND before = 'start'", "ledger_log", local=_LIVED))
def record_failure(spark, d):
    """L3: applied_at stays that of the latest start (or success)."""
    return ll.record_failure(log(spark, d), KEY)


@register("remove_version", o.sql(
    "SELECT target_id, version FROM (" + _LAST.format(
        p="target_id, version", t="(SELECT * FROM ledger_log WHERE op IN ('start', 'remove'))")
    + ") WHERE op = 'remove'", "ledger_log"))
def remove_version(spark, d):
    """L4: rows the log has deleted."""
    return ll.removed_keys(log(spark, d), KEY)


@register("blocked_after_failure", o.sql(
    "SELECT e.target_id, e.version, e.event_id, coalesce(e.ts > f.f_ts OR (e.ts = f.f_ts AND e.event_id > f.f_seq), "
    "false) AS blocked FROM ledger_log e LEFT JOIN (SELECT target_id, ts AS f_ts, event_id AS f_seq FROM ("
    "SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY ts, event_id) AS rn FROM ledger_log "
    "WHERE op = 'failure') WHERE rn = 1) f ON f.target_id = e.target_id", "ledger_log"))
def blocked_after_failure(spark, d):
    """Events after the first failure of the same target."""
    return ll.blocked_after_failure(log(spark, d), ["target_id"]).select(
        "target_id", "version", "event_id", "blocked")


@register("execution_count", o.sql(
    "SELECT target_id, version, count(*) AS execution_count FROM ledger_log WHERE op = 'start' "
    "GROUP BY target_id, version", "ledger_log"))
def execution_count(spark, d):
    """A12."""
    return ll.execution_count(log(spark, d), KEY)


_HIST = [
    ("hist", "SELECT target_id, version, count(*) AS execution_count FROM ledger_log "
     f"WHERE op = 'start' AND ts < TIMESTAMP '{CUTOFF}' GROUP BY target_id, version"),
    ("run", f"SELECT DISTINCT target_id, version FROM ledger_log WHERE op = 'start' AND ts >= TIMESTAMP '{CUTOFF}'"),
]


def _hist_run(spark, d):
    lgd = log(spark, d)
    starts = lgd.where(F.col("op") == "start")
    hist = ll.execution_count(starts.where(F.col("ts") < F.lit(CUTOFF).cast("timestamp_ntz")), KEY)
    run = starts.where(F.col("ts") >= F.lit(CUTOFF).cast("timestamp_ntz")).select(*KEY)
    return hist, run


@register("enrich_log_self", o.sql(
    "SELECT r.target_id, r.version, CAST(coalesce(h.execution_count + 1, 1) AS BIGINT) AS execution_count "
    "FROM run r LEFT JOIN hist h ON h.target_id = r.target_id AND h.version = r.version", "ledger_log",
    local=_HIST))
def enrich_log_self(spark, d):
    """Each script of the current run reads its previous count."""
    hist, run = _hist_run(spark, d)
    return ll.bump_counts(hist, run, KEY).where("updated").select(*KEY, "execution_count")


@register("upsert_by_key", o.sql(
    "SELECT coalesce(h.target_id, r.target_id) AS target_id, coalesce(h.version, r.version) AS version, "
    "CAST(CASE WHEN r.target_id IS NOT NULL THEN coalesce(h.execution_count + 1, 1) ELSE h.execution_count END "
    "AS BIGINT) AS execution_count, r.target_id IS NOT NULL AS updated FROM hist h FULL OUTER JOIN run r "
    "ON h.target_id = r.target_id AND h.version = r.version", "ledger_log", local=_HIST))
def upsert_by_key(spark, d):
    """M6: insert-or-replace of the execution log with counter + 1."""
    hist, run = _hist_run(spark, d)
    return ll.bump_counts(hist, run, KEY)


@register("log_newest_first", o.sql(
    "SELECT target_id, event_id, row_number() OVER (PARTITION BY target_id ORDER BY ts DESC, event_id DESC) "
    "AS recent_pos FROM ledger_log", "ledger_log"))
def log_newest_first(spark, d):
    """The execution view newest first, as a position per target."""
    lg_ = log(spark, d).select("target_id", "event_id", "ts")
    return ll.newest_first(lg_, ["target_id"]).select("target_id", "event_id", "recent_pos")


# --- rollback ----------------------------------------------------------------------

_ROLLABLE = "SELECT * FROM ledger WHERE migration_type = 'versioned' AND success"
_STEPS_SQL = (f"SELECT target_id, migration_id, version, filename, rollback_order, "
              f"count(*) OVER (PARTITION BY target_id) AS rollback_total FROM (SELECT *, row_number() OVER ("
              f"PARTITION BY target_id ORDER BY version DESC, migration_id) AS rollback_order FROM ({_ROLLABLE})) "
              f"WHERE rollback_order <= {STEPS}")
_TOV_SQL = (f"SELECT target_id, migration_id, version, filename, row_number() OVER (PARTITION BY target_id "
            f"ORDER BY version DESC, migration_id) AS rollback_order, count(*) OVER (PARTITION BY target_id) "
            f"AS rollback_total FROM ({_ROLLABLE}) WHERE version > {{t}}")
_CHECK_LOCAL = [("bv", "SELECT target_id, version, arg_max(has_rollback, path) AS has_rollback FROM skeys "
                       "WHERE kind = 'versioned' GROUP BY target_id, version")]


def _checked(plan_sql: str) -> str:
    return ("SELECT p.*, CASE WHEN bv.has_rollback IS NULL THEN 'MISSING_FILE' WHEN NOT bv.has_rollback "
            "THEN 'NO_DOWN' ELSE 'OK' END AS check_status, "
            "CASE WHEN bv.has_rollback IS NULL THEN printf('Migration error: Migration file not found for version %d', "
            "p.version) WHEN NOT bv.has_rollback THEN printf('Migration %s cannot be rolled back: no rollback SQL "
            f"found', p.filename) END AS message FROM ({plan_sql}) p LEFT JOIN bv ON bv.target_id = p.target_id "
            "AND bv.version = p.version")


@register("rollback_steps", o.sql(_STEPS_SQL, "ledger"))
def rollback_steps(spark, d):
    """Newest three successful versioned rows per target."""
    return rb.plan_steps(ledger_names(spark, d), STEPS).select(
        "target_id", "migration_id", "version", "filename", "rollback_order", "rollback_total")


@register("rollback_order", o.sql(
    "SELECT target_id, migration_id, rollback_order, rollback_total, "
    "printf('%d/%d', rollback_order, rollback_total) AS progress FROM (" + _TOV_SQL.format(t=TO_VERSION) + ")",
    "ledger"))
def rollback_order(spark, d):
    """Rollback progress i/total, newest first (ToVersion 500)."""
    p = rb.plan_to_version(ledger_names(spark, d), TO_VERSION)
    return p.select("target_id", "migration_id", "rollback_order", "rollback_total",
                    F.format_string("%d/%d", "rollback_order", "rollback_total").alias("progress"))


@register("take_until", o.sql(
    f"SELECT target_id, migration_id, version FROM ({_ROLLABLE}) WHERE version > {TO_VERSION}", "ledger"))
def take_until(spark, d):
    """Newest first until the first version <= target: on ordered input
    this is the filter version > target."""
    return lg.above_target(lg.rollbackable(ledger_names(spark, d)), TO_VERSION).select(
        "target_id", "migration_id", "version")


@register("rollback_plan", o.sql(_checked(_STEPS_SQL), "ledger", "skeys", local=_CHECK_LOCAL))
def rollback_plan(spark, d):
    """R4 (Steps 3): plan rows with the Down-text check."""
    p = rb.plan_steps(ledger(spark, d), STEPS).select(
        "target_id", "migration_id", "version", "filename", "rollback_order", "rollback_total")
    return rb.check_plan(p, keys(spark, d))


@register("rollback_check", o.sql(_checked(_TOV_SQL.format(t=TO_VERSION)), "ledger", "skeys", local=_CHECK_LOCAL))
def rollback_check(spark, d):
    """J6 (ToVersion 500): missing file / no Down / ok per planned row."""
    p = rb.plan_to_version(ledger(spark, d), TO_VERSION).select(
        "target_id", "migration_id", "version", "filename", "rollback_order", "rollback_total")
    return rb.check_plan(p, keys(spark, d))


@register("rollback_summary", o.sql(
    "SELECT t.target_id, 'to_version' AS strategy, coalesce(n.rollback_total, 0) AS rollback_total, "
    "CASE WHEN coalesce(n.rollback_total, 0) = 0 THEN 'INVALID_TARGET' WHEN e.check_status IS NOT NULL "
    "THEN e.check_status ELSE 'OK' END AS status, "
    f"CASE WHEN coalesce(n.rollback_total, 0) = 0 THEN printf('Cannot rollback to version %d: migration not found "
    f"or not applied', {SUMMARY_TO_VERSION}) WHEN e.check_status IS NOT NULL THEN e.message END AS message "
    "FROM (SELECT DISTINCT target_id FROM ledger) t "
    "LEFT JOIN (SELECT target_id, count(*) AS rollback_total FROM chk GROUP BY target_id) n "
    "ON n.target_id = t.target_id LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id "
    "ORDER BY rollback_order) AS rn FROM chk WHERE check_status <> 'OK') WHERE rn = 1) e ON e.target_id = t.target_id",
    "ledger", "skeys", local=_CHECK_LOCAL + [("chk", _checked(_TOV_SQL.format(t=SUMMARY_TO_VERSION)))]))
def rollback_summary(spark, d):
    """R4 verdict (ToVersion 900): first failing row decides; INVALID_TARGET
    when nothing is above the target."""
    led = ledger(spark, d)
    p = rb.plan_to_version(led, SUMMARY_TO_VERSION)
    return rb.plan_summary(rb.check_plan(p, keys(spark, d)), led, "to_version", SUMMARY_TO_VERSION)


@register("baselines_asc", o.sql(
    "SELECT target_id, migration_id, version, row_number() OVER (PARTITION BY target_id ORDER BY version, "
    "migration_id) AS baseline_pos FROM ledger WHERE migration_type = 'baseline'", "ledger"))
def baselines_asc(spark, d):
    """O5."""
    return rb.baselines_asc(inputs.baselines(spark, d)).select("target_id", "migration_id", "version", "baseline_pos")


@register("ledger_order", o.sql(
    "SELECT target_id, migration_id, row_number() OVER (PARTITION BY target_id ORDER BY "
    "CASE WHEN migration_type = 'versioned' THEN 0 ELSE 1 END, CASE WHEN migration_type = 'versioned' THEN version "
    "ELSE 0 END, filename, migration_id) AS ledger_pos FROM ledger", "ledger"))
def ledger_order(spark, d):
    """O2: versioned rows first by version, all others by file name."""
    led = ledger_names(spark, d).select("target_id", "migration_id", "migration_type", "version", "filename")
    return ordinal(freeze(led), ["target_id"], lg.ledger_order_key(), "ledger_pos").select(
        "target_id", "migration_id", "ledger_pos")


@register("stored_checksum", o.sql(
    "SELECT s.target_id, s.identifier AS migration_id, l.checksum FROM skeys s LEFT JOIN lrun l "
    "ON l.target_id = s.target_id AND l.migration_id = s.identifier", "skeys", "lrun"))
def stored_checksum(spark, d):
    """Checksum by id, any status (baseline rows excluded, Q11)."""
    ids = keys(spark, d).select("target_id", F.col("identifier").alias("migration_id"))
    return rc.stored_checksum(ledger(spark, d), ids)


_PROPOSALS = ("SELECT target_id, CAST(CASE target_id WHEN 'src2' THEN 50000000 WHEN 'src3' THEN 60000000 "
              "ELSE min(doc_id) + 150 END AS BIGINT) AS new_baseline FROM scripts GROUP BY target_id")
_BASELINE_SQL = (
    "SELECT p.target_id, p.new_baseline AS version, coalesce(c.existing_runs, 0) AS existing_runs, "
    "coalesce(c.conflicts, 0) AS conflicts, coalesce(k.skips, 0) AS would_skip, CASE WHEN coalesce(c.conflicts, 0) > 0 THEN 'CONFLICT' "
    "WHEN e.v IS NOT NULL THEN 'EXISTS' ELSE 'CREATE' END AS status, "
    "CASE WHEN coalesce(c.conflicts, 0) > 0 THEN printf('Cannot create baseline version %d - conflicting migrations "
    "exist at or above this version', p.new_baseline) WHEN e.v IS NOT NULL THEN printf('Baseline version %d already "
    "exists', p.new_baseline) END AS message, "
    f"printf('baseline_%04d_%s', p.new_baseline, '{BASELINE_DESCRIPTION.replace(' ', '_')}') AS filename, "
    f"TIMESTAMP '{BASELINE_AT}' AS applied_at FROM props p "
    "LEFT JOIN (SELECT l.target_id, count(*) AS existing_runs, count(*) FILTER (WHERE l.version >= q.new_baseline) AS conflicts "
    "FROM lrun l JOIN props q ON q.target_id = l.target_id GROUP BY l.target_id) c ON c.target_id = p.target_id "
    "LEFT JOIN (SELECT DISTINCT target_id, version AS v FROM ledger WHERE migration_type = 'baseline') e "
    "ON e.target_id = p.target_id AND e.v = p.new_baseline "
    "LEFT JOIN (SELECT s.target_id, count(*) AS skips FROM skeys s JOIN props q ON q.target_id = s.target_id "
    "WHERE s.kind = 'versioned' AND s.version <= q.new_baseline GROUP BY s.target_id) k ON k.target_id = p.target_id")


def _baseline_plan(spark, d):
    return rb.baseline_plan(ledger_names(spark, d), b.proposed_baselines(spark, d), BASELINE_DESCRIPTION,
                            BASELINE_AT, inputs.valid_names(spark, d))


@register("baseline_would_skip", o.sql(
    "SELECT s.target_id, s.path, s.version, p.new_baseline FROM skeys s JOIN props p USING (target_id) "
    "WHERE s.kind = 'versioned' AND s.version <= p.new_baseline", "skeys", "scripts", local=[("props", _PROPOSALS)]))
def baseline_would_skip(spark, d):
    """The scripts a new baseline would skip, per target."""
    return rb.would_skip(inputs.valid_names(spark, d), b.proposed_baselines(spark, d)).select(
        "target_id", "path", "version", "new_baseline")


@register("baseline_report", o.sql(_BASELINE_SQL, "ledger", "lrun", "skeys", "scripts", local=[("props", _PROPOSALS)]))
def baseline_report(spark, d):
    """R5 (+F5 conflicts, A5 existence, P19 file name)."""
    return _baseline_plan(spark, d)


@register("create_baseline", o.sql(
    "SELECT target_id, CAST(version AS VARCHAR) AS migration_id, 'baseline' AS migration_type, version, filename, "
    "'baseline' AS checksum, applied_at, CAST(0 AS BIGINT) AS execution_time_ms, true AS success FROM ("
    + _BASELINE_SQL + ") WHERE status = 'CREATE'", "ledger", "lrun", "skeys", "scripts", local=[("props", _PROPOSALS)]))
def create_baseline(spark, d):
    """Baseline rows to append where no conflict and no duplicate."""
    return rb.baseline_rows(_baseline_plan(spark, d))
