"""Registered queries: scripts against the ledger (S3, S6, S7, P13-P15, P18,
P21, F2-F6, J1-J8, A2-A10, A13, W1-W3, T3, R1-R3, R6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import oracle as o
from ..functions import decode as dc
from ..operators import checks as ck
from ..operators import corpus as cp
from ..operators import incremental as inc
from ..operators import reconcile as rc
from ..operators.scan import ordinal
from ..plans import reports as rp
from ..session import scratch_path
from ..sources import bindings as b
from ..sources import ledger as lg
from . import inputs
from .registry import register

RECONCILED_BUCKETS = 64       # a table to keep wants files of some 128 MB


def keys(spark, d):
    return inputs.keys(spark, d)


def ledger(spark, d):
    return inputs.ledger(spark, d)


def names(spark, d):
    return inputs.valid_names(spark, d)


def ledger_names(spark, d):
    return inputs.ledger_names(spark, d)


# --- scans / decoding --------------------------------------------------------

@register("ledger_scan", o.sql(
    "SELECT target_id, migration_id, migration_type, version, filename, checksum, applied_at, "
    "execution_time_ms, success FROM ledger", "ledger"))
def ledger_scan(spark, d):
    """S3: the ledger with its fixed types; the text form decodes back to it
    (see ``decode_ledger_text``)."""
    return lg.decode_ledger(lg.ledger_as_text(ledger(spark, d)))


@register("rows_as_text", o.sql(
    "SELECT coalesce(CAST(migration_id AS VARCHAR), 'NULL') AS migration_id, "
    "coalesce(CAST(version AS VARCHAR), 'NULL') AS version, "
    "coalesce(CAST(success AS VARCHAR), 'NULL') AS success, "
    "coalesce(CAST(execution_time_ms AS VARCHAR), 'NULL') AS execution_time_ms FROM ledger", "ledger"))
def rows_as_text(spark, d):
    """Every cell as text, NULL as 'NULL'."""
    return lg.rows_as_text(ledger_names(spark, d).select("migration_id", "version", "success", "execution_time_ms"))


@register("scalar_lookup", o.sql(
    "SELECT t.target_id, coalesce(CAST(max(l.version) AS VARCHAR), 'NULL') AS value FROM "
    "targets t LEFT JOIN ledger l ON l.target_id = t.target_id AND l.success GROUP BY t.target_id", "targets", "ledger"))
def scalar_lookup(spark, d):
    """A one-cell query per target (its highest successful version, any
    row type) as text, 'NULL' when there is none."""
    found = ledger_names(spark, d).where("success").groupBy("target_id").agg(F.max("version").alias("value"))
    return lg.rows_as_text(b.targets(spark, d).join(found, "target_id", "left").select("target_id", "value"))


@register("decode_timestamp", o.sql(
    "SELECT event_id, coalesce(try_strptime(txt, '%Y-%m-%dT%H:%M:%S.%fZ'), try_strptime(txt, '%Y-%m-%d %H:%M:%S'), "
    "try_strptime(txt, '%Y-%m-%d %H:%M:%S.%f')) AS ts_decoded FROM ("
    "SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') "
    "WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE CASE WHEN event_id % 7 = 0 THEN 'garbage' "
    "ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END END AS txt FROM events)"))
def decode_timestamp(spark, d):
    """Ledger timestamps written as text in three formats decode to the
    same instant; unreadable text decodes to NULL (SURVEY Q14 fix)."""
    e = b.table(spark, d, "events").select("event_id", "ts")
    k = F.col("event_id") % 3
    txt = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
           .when(k == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .otherwise(F.when(F.col("event_id") % 7 == 0, F.lit("garbage"))
                      .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))))
    return e.select("event_id", dc.decode_timestamp(txt).alias("ts_decoded"))


@register("decode_boolean", o.sql(
    "SELECT event_id, lower(txt) IN ('true', '1', 't', 'yes', 'y') AS flag FROM ("
    "SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'y' WHEN 2 THEN 'No' WHEN 3 THEN '1' "
    "WHEN 4 THEN event_type ELSE 'NULL' END AS txt FROM events)"))
def decode_boolean(spark, d):
    """The true-set {true,1,t,yes,y}, any case; anything else false."""
    e = b.table(spark, d, "events").select("event_id", "event_type")
    k = F.col("event_id") % 6
    txt = (F.when(k == 0, "TRUE").when(k == 1, "y").when(k == 2, "No").when(k == 3, "1")
           .when(k == 4, F.col("event_type")).otherwise("NULL"))
    return e.select("event_id", dc.decode_boolean(txt).alias("flag"))


@register("decode_int_or_zero", o.sql(
    "SELECT event_id, CASE WHEN regexp_matches(txt, '^[+-]?[0-9]+$') AND try_cast(txt AS BIGINT) BETWEEN 0 AND 4294967295 "
    "THEN try_cast(txt AS BIGINT) ELSE 0 END AS n, CASE WHEN regexp_matches(txt, '^[+-]?[0-9]+$') AND try_cast(txt AS "
    "BIGINT) BETWEEN -2147483648 AND 2147483647 THEN try_cast(txt AS BIGINT) ELSE 0 END AS ms "
    "FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN CAST(user_id AS VARCHAR) "
    "WHEN 1 THEN CAST(value AS VARCHAR) WHEN 2 THEN ' 5' WHEN 3 THEN '-' || CAST(event_id AS VARCHAR) "
    "WHEN 4 THEN CAST(4294967295 + user_id % 2 AS VARCHAR) WHEN 5 THEN CAST(2147483647 + user_id % 2 AS VARCHAR) "
    "ELSE '+' || CAST(event_id AS VARCHAR) END AS txt FROM events)"))
def decode_int_or_zero(spark, d):
    """Text to a version (unsigned) and to a duration (signed), 0 when
    it is no integer literal or out of range."""
    e = b.table(spark, d, "events").select("event_id", "user_id", "value")
    k, odd = F.col("event_id") % 7, F.col("user_id") % 2
    own = F.col("event_id").cast("string")
    txt = (F.when(k == 0, F.col("user_id").cast("string")).when(k == 1, F.col("value").cast("string"))
           .when(k == 2, F.lit(" 5")).when(k == 3, F.concat(F.lit("-"), own))
           .when(k == 4, (F.lit(4294967295) + odd).cast("string")).when(k == 5, (F.lit(2147483647) + odd).cast("string"))
           .otherwise(F.concat(F.lit("+"), own)))
    return e.select("event_id", dc.decode_int_or_zero(txt).alias("n"),
                    dc.decode_int_or_zero(txt, dc.I32_MIN, dc.I32_MAX).alias("ms"))


# --- filters over the ledger ------------------------------------------------------

@register("filter_rollbackable", o.sql(
    "SELECT target_id, migration_id FROM ledger WHERE migration_type = 'versioned' AND success", "ledger"))
def filter_rollbackable(spark, d):
    """F2."""
    return lg.rollbackable(ledger_names(spark, d)).select("target_id", "migration_id")


@register("filter_failed", o.sql("SELECT target_id, migration_id FROM ledger WHERE NOT success", "ledger"))
def filter_failed(spark, d):
    """F3."""
    return ledger_names(spark, d).where(~F.col("success")).select("target_id", "migration_id")


@register("filter_below_baseline", o.sql(
    "SELECT s.target_id, s.path, s.version <= b.baseline_version AS below_baseline FROM skeys s "
    "JOIN baselines b USING (target_id) WHERE s.kind = 'versioned'", "skeys", "baselines"))
def filter_below_baseline(spark, d):
    """Versioned scripts at or below their target's baseline."""
    v = rc.with_baseline(names(spark, d).where(F.col("kind") == "versioned"), ledger_names(spark, d))
    return v.where(F.col("baseline_version").isNotNull()).select("target_id", "path", "below_baseline")


@register("filter_conflicting", o.sql(
    "SELECT l.target_id, l.migration_id, l.version FROM lrun l JOIN ("
    "SELECT target_id, CASE target_id WHEN 'src2' THEN 50000000 WHEN 'src3' THEN 60000000 ELSE min(doc_id) + 150 END AS "
    "new_baseline FROM scripts GROUP BY target_id) n USING (target_id) "
    "WHERE l.version >= n.new_baseline", "lrun", "scripts"))
def filter_conflicting(spark, d):
    """ledger rows at or above a proposed new baseline (min id + 150)."""
    led = rc.latest_runs(ledger_names(spark, d))
    prop = b.proposed_baselines(spark, d)
    return lg.conflicting(led, prop).select("target_id", "migration_id", "version")


@register("filter_above_target", o.sql(
    "SELECT target_id, migration_id, version FROM ledger WHERE migration_type = 'versioned' AND success "
    "AND version > 500", "ledger"))
def filter_above_target(spark, d):
    """Successful versioned rows above a rollback target (500)."""
    return lg.above_target(lg.rollbackable(ledger_names(spark, d)), 500).select("target_id", "migration_id", "version")


# --- joins -------------------------------------------------------------------------

@register("pending_versioned", o.sql(
    "SELECT s.target_id, s.path, s.version FROM skeys s LEFT JOIN baselines b USING (target_id) "
    "WHERE s.kind = 'versioned' AND NOT coalesce(s.version <= b.baseline_version, false) "
    "AND NOT EXISTS (SELECT 1 FROM ledger l WHERE l.target_id = s.target_id AND l.version = s.version "
    "AND l.migration_type = 'versioned' AND l.success)", "skeys", "baselines", "ledger"))
def pending_versioned(spark, d):
    """J1."""
    return rc.pending_versioned(names(spark, d), ledger_names(spark, d)).select("target_id", "path", "version")


@register("pending_repeatable", o.sql(
    "SELECT s.target_id, s.path, s.identifier FROM skeys s WHERE s.kind = 'repeatable' AND NOT EXISTS ("
    "SELECT 1 FROM lrun l WHERE l.target_id = s.target_id AND l.migration_id = s.identifier "
    "AND l.checksum = s.checksum AND l.success)", "skeys", "lrun"))
def pending_repeatable(spark, d):
    """J2."""
    return rc.pending_repeatable(keys(spark, d), ledger(spark, d)).select("target_id", "path", "identifier")


_STATUS_SQL = """
SELECT s.target_id, s.identifier AS migration_id, s.path,
  CASE WHEN s.kind = 'repeatable' THEN 'R' ELSE 'V' END AS tag, s.filename,
  CASE WHEN l.migration_type IS NULL THEN 'PENDING' WHEN l.applied_at IS NOT NULL AND l.success THEN 'APPLIED'
       ELSE 'FAILED' END AS status,
  l.applied_at, l.execution_time_ms,
  coalesce(l.migration_type IS NOT NULL AND l.checksum <> s.checksum, false) AS checksum_mismatch,
  coalesce(s.kind = 'versioned' AND s.version <= b.baseline_version, false) AS below_baseline
FROM skeys s LEFT JOIN lrun l ON l.target_id = s.target_id AND l.migration_id = s.identifier
LEFT JOIN baselines b ON b.target_id = s.target_id"""


@register("status_join", o.sql(
    "SELECT target_id, migration_id, path, status, checksum_mismatch FROM status", "skeys", "lrun",
    "baselines").replace("FROM status", f"FROM ({_STATUS_SQL})"))
def status_join(spark, d):
    """J3 + P18 + P21."""
    return rc.status_join(keys(spark, d), ledger(spark, d)).select(
        "target_id", "migration_id", "path", "status", "checksum_mismatch")


@register("orphans", o.sql(
    "SELECT l.target_id, l.migration_id, l.filename FROM lrun l WHERE NOT EXISTS (SELECT 1 FROM skeys s "
    "WHERE s.target_id = l.target_id AND s.identifier = l.migration_id)", "lrun", "skeys"))
def orphans(spark, d):
    """J4."""
    return rc.orphans(names(spark, d), ledger_names(spark, d)).select("target_id", "migration_id", "filename")


@register("checksum_drift", o.sql(
    "SELECT s.target_id, s.identifier AS migration_id, l.checksum AS stored_checksum, s.checksum AS current_checksum "
    "FROM skeys s JOIN lrun l ON l.target_id = s.target_id AND l.migration_id = s.identifier "
    "WHERE l.checksum <> s.checksum", "skeys", "lrun"))
def checksum_drift(spark, d):
    """J5."""
    return rc.checksum_drift(keys(spark, d), ledger(spark, d)).select(
        "target_id", "migration_id", "stored_checksum", F.col("checksum").alias("current_checksum"))


@register("baseline_skip", o.sql(
    "SELECT s.target_id, s.path, s.version, b.baseline_version FROM skeys s JOIN baselines b USING (target_id) "
    "WHERE s.kind = 'versioned' AND s.version <= b.baseline_version", "skeys", "baselines"))
def baseline_skip(spark, d):
    """Scripts the baseline skips."""
    v = rc.with_baseline(names(spark, d).where(F.col("kind") == "versioned"), ledger_names(spark, d))
    return v.where("below_baseline").select("target_id", "path", "version", "baseline_version")


_RECONCILE_SQL = """
SELECT coalesce(s.target_id, l.target_id) AS target_id, coalesce(s.identifier, l.migration_id) AS migration_id,
  coalesce(s.kind, l.migration_type) AS kind, coalesce(s.version, l.version) AS version,
  coalesce(s.filename, l.filename) AS filename,
  CASE WHEN l.migration_id IS NULL THEN 'PENDING' WHEN s.identifier IS NULL THEN 'ORPHAN'
       WHEN NOT (l.applied_at IS NOT NULL AND l.success) THEN 'FAILED'
       WHEN l.checksum <> s.checksum THEN 'DRIFT' ELSE 'APPLIED' END AS state
FROM skeys s FULL OUTER JOIN lrun l ON l.target_id = s.target_id AND l.migration_id = s.identifier"""


@register("reconcile_full", o.sql(_RECONCILE_SQL, "skeys", "lrun"))
def reconcile_full(spark, d):
    """Scripts and ledger in one result with a state per row."""
    return rc.reconcile(keys(spark, d), ledger(spark, d)).select(
        "target_id", "migration_id", "kind", "version", "filename", "state")


def _kept_reconciliation(spark, d):
    """The reconciled table after a load with the ledger as it was a week before
    its last run, and a run over the rows that came since."""
    rows = ledger(spark, d)
    last = rows.agg(F.max("applied_at")).first()[0]
    newer = (F.coalesce(F.col("applied_at") > F.lit(str(last)).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS"), F.lit(False))
             if last is not None else F.lit(False))
    scripts = keys(spark, d).withColumnRenamed("identifier", "migration_id").select(*inc.KEYS, *inc.SCRIPT, F.lit(1).alias("sign"))
    table = inc.create(spark, scratch_path(spark, "reconciled"), RECONCILED_BUCKETS)
    inc.publish(table, "load", scripts, rows.where(~newer))
    inc.publish(table, "week", ledger=rows.where(newer))
    return table


@register("reconcile_incremental", o.sql(_RECONCILE_SQL, "skeys", "lrun"))
def reconcile_incremental(spark, d):
    """J8 from a table that two runs keep up to date, the second by its own keys alone."""
    return inc.reconciled(_kept_reconciliation(spark, d)).select(
        "target_id", "migration_id", "kind", "version", "filename", "state")


@register("reconcile_counts", o.sql(
    f"SELECT target_id, state, count(*) AS n FROM ({_RECONCILE_SQL}) GROUP BY target_id, state", "skeys", "lrun"))
def reconcile_counts(spark, d):
    """A2 over J8, summed from the signed changes of the runs."""
    return inc.state_counts(_kept_reconciliation(spark, d))


# --- aggregates -------------------------------------------------------------------------

@register("status_counts", o.sql(
    "SELECT t.target_id, t.total, t.applied, t.pending, t.failed, t.skipped, t.checksum_mismatches, "
    "v.latest_version, b.baseline_version, coalesce(f.n, 0) AS failed_ledger_rows FROM ("
    "SELECT target_id, count(*) AS total, count(*) FILTER (WHERE status = 'APPLIED') AS applied, "
    "count(*) FILTER (WHERE status = 'PENDING' AND NOT below_baseline) AS pending, count(*) FILTER (WHERE status = 'FAILED') AS failed, "
    "count(*) FILTER (WHERE below_baseline) AS skipped, count(*) FILTER (WHERE checksum_mismatch) AS checksum_mismatches "
    f"FROM ({_STATUS_SQL}) GROUP BY target_id) t "
    "LEFT JOIN (SELECT target_id, max(version) AS latest_version FROM ledger WHERE migration_type = 'versioned' "
    "AND success GROUP BY target_id) v USING (target_id) LEFT JOIN baselines b USING (target_id) "
    "LEFT JOIN (SELECT target_id, count(*) AS n FROM ledger WHERE NOT success GROUP BY target_id) f "
    "USING (target_id)", "skeys", "lrun", "baselines", "ledger"))
def status_counts(spark, d):
    """A2 (+A3 latest version, A4 baseline)."""
    return rc.status_counts(keys(spark, d), ledger(spark, d))


@register("latest_version", o.sql(
    "SELECT target_id, version, row_number() OVER (PARTITION BY target_id ORDER BY version) AS pos "
    "FROM (SELECT DISTINCT target_id, version FROM ledger WHERE migration_type = 'versioned' AND success)",
    "ledger"))
def latest_version(spark, d):
    """A3: the ordered list of applied versions per target, as rows with
    their position (the last position is the latest version)."""
    return lg.applied_versions(ledger_names(spark, d))


@register("baseline_version", o.sql(
    "SELECT target_id, max(version) AS baseline_version FROM ledger WHERE migration_type = 'baseline' "
    "GROUP BY target_id", "ledger"))
def baseline_version(spark, d):
    """A4."""
    return rc.baseline_version(inputs.baselines(spark, d))


@register("is_applied_count", o.sql(
    "SELECT s.target_id, s.path, s.version, EXISTS (SELECT 1 FROM ledger l WHERE l.target_id = s.target_id "
    "AND l.version = s.version AND l.migration_type = 'versioned' AND l.success) AS is_applied, "
    "EXISTS (SELECT 1 FROM ledger l WHERE l.target_id = s.target_id AND l.version = s.version "
    "AND l.migration_type = 'baseline') AS is_baseline FROM skeys s WHERE s.kind = 'versioned'",
    "skeys", "ledger"))
def is_applied_count(spark, d):
    """A5."""
    return rc.is_applied(names(spark, d), ledger_names(spark, d))


@register("applied_matches_corpus", o.sql(
    "SELECT coalesce(f.target_id, a.target_id) AS target_id, coalesce(f.files, 0) AS files, "
    "coalesce(a.applied, 0) AS applied, coalesce(f.files, 0) = coalesce(a.applied, 0) AS matches FROM "
    "(SELECT target_id, count(*) AS files FROM skeys GROUP BY target_id) f FULL OUTER JOIN "
    "(SELECT target_id, count(*) AS applied FROM lrun WHERE success GROUP BY target_id) a USING (target_id)",
    "skeys", "lrun"))
def applied_matches_corpus(spark, d):
    """A13."""
    return ck.applied_matches_corpus(names(spark, d), ledger_names(spark, d))


# --- sequence checks (B3) ----------------------------------------------------------------

@register("version_gaps", o.sql(
    "SELECT target_id, version, position, position <> version AS is_gap FROM ("
    "SELECT target_id, version, row_number() OVER (PARTITION BY target_id ORDER BY version) AS position FROM seq)",
    "seq"))
def version_gaps(spark, d):
    """W1 over B3."""
    return ck.version_positions(b.seq(spark, d)).select("target_id", "version", "position", "is_gap")


@register("later_duplicates", o.sql(
    "SELECT target_id, version, occurrence, occurrence > 1 AS is_later_duplicate FROM ("
    "SELECT target_id, version, row_number() OVER (PARTITION BY target_id, version) AS occurrence FROM seq)",
    "seq"))
def later_duplicates(spark, d):
    """W2 over B3."""
    return ck.later_duplicates(b.seq(spark, d), "version").select(
        "target_id", "version", "occurrence", "is_later_duplicate")


@register("duplicate_versions", o.sql(
    "SELECT target_id, version, count(*) AS occurrences FROM seq GROUP BY target_id, version HAVING count(*) > 1",
    "seq"))
def duplicate_versions(spark, d):
    """A6 over B3."""
    return ck.duplicate_groups(b.seq(spark, d), "version")


@register("duplicate_names", o.sql(
    "SELECT target_id, split_part(name, '_', 1) AS name_key, count(*) AS occurrences FROM skeys "
    "WHERE kind = 'repeatable' GROUP BY target_id, split_part(name, '_', 1) HAVING count(*) > 1", "skeys"))
def duplicate_names(spark, d):
    """Repeatable names (their language part) occurring more than once."""
    r = names(spark, d).where(F.col("kind") == "repeatable").withColumn(
        "name_key", F.substring_index("name", "_", 1))
    return ck.duplicate_groups(r, "name_key")


# --- reports --------------------------------------------------------------------------------

@register("status_report", o.sql(_STATUS_SQL, "skeys", "lrun", "baselines"))
def status_report(spark, d):
    """R2: one row per script with label, time and drift flag (the flagship)."""
    return rp.status_report(keys(spark, d), ledger(spark, d))


@register("status_report_no_ledger", o.sql(
    "SELECT target_id, identifier AS migration_id, path, CASE WHEN kind = 'repeatable' THEN 'R' ELSE 'V' END AS tag, "
    "filename, 'PENDING' AS status, CAST(NULL AS TIMESTAMP) AS applied_at, CAST(NULL AS BIGINT) AS execution_time_ms, "
    "false AS checksum_mismatch, false AS below_baseline FROM skeys", "skeys"))
def status_report_no_ledger(spark, d):
    """R2 where the ledger table is missing: every script is pending."""
    return rp.status_report(names(spark, d), None)


@register("validate_files", o.sql(
    "SELECT target_id, count(*) AS migrations, count(*) FILTER (WHERE kind = 'versioned') AS versioned, "
    "count(*) FILTER (WHERE kind = 'repeatable') AS repeatable, CAST(sum(line_count) AS BIGINT) AS lines FROM skeys "
    "GROUP BY target_id", "skeys"))
def validate_files(spark, d):
    """R3 where the ledger table is missing: the file-based counts."""
    return rp.validate_files(cp.script_keys(cp.parse_scripts(b.scripts(spark, d))))


@register("marker_findings", o.sql(
    "SELECT target_id, 'marker_in_comment' AS \"check\", path AS subject, printf('Marker ''-- UP'' of %s is part of a "
    "longer comment', path) AS message, 'WARN' AS severity FROM parsed WHERE marker_style = 2 AND "
    "regexp_matches(substr(lower(body), instr(lower(body), '-- up') + 5, 1), '[a-z]')", "parsed"))
def marker_findings(spark, d):
    """Q3: Up markers found inside a longer comment."""
    return ck.marker_findings(cp.parse_scripts(b.scripts(spark, d)))


@register("unreadable_times", o.sql(
    "SELECT target_id, 'unreadable_time' AS \"check\", migration_id AS subject, printf('Timestamp ''%s'' of migration %s "
    "cannot be read', txt, migration_id) AS message, 'WARN' AS severity FROM (SELECT *, strftime(applied_at, "
    "'%d.%m.%Y') AS txt FROM ledger WHERE migration_type = 'repeatable')", "ledger"))
def unreadable_times(spark, d):
    """Q14: ledger times in a form no rule reads (here those of repeatables)."""
    led = ledger_names(spark, d)
    stamp = (F.when(F.col("migration_type") == "repeatable", F.date_format("applied_at", "dd.MM.yyyy"))
             .otherwise(F.date_format("applied_at", "yyyy-MM-dd HH:mm:ss")))
    return ck.unreadable_times(lg.rows_as_text(led.select("target_id", "migration_id", stamp.alias("applied_at"))))


@register("plan_report", o.sql(
    "SELECT target_id, path, filename, version, tag, line_count, checksum8, preview, preview_more, "
    "row_number() OVER (PARTITION BY target_id ORDER BY kind = 'repeatable', version NULLS FIRST, name, path, checksum) "
    "AS plan_pos FROM ("
    "SELECT s.*, CASE WHEN s.kind = 'repeatable' THEN 'R' ELSE 'V' END AS tag, substr(s.checksum, 1, 8) AS checksum8, "
    f"{o.preview_sql('p.up_sql')} AS preview, s.line_count > 3 AS preview_more "
    "FROM skeys s JOIN parsed p ON p.doc_id = s.doc_id LEFT JOIN baselines b ON b.target_id = s.target_id "
    "WHERE (s.kind = 'versioned' AND NOT coalesce(s.version <= b.baseline_version, false) AND NOT EXISTS ("
    "SELECT 1 FROM ledger l WHERE l.target_id = s.target_id AND l.version = s.version "
    "AND l.migration_type = 'versioned' AND l.success)) OR (s.kind = 'repeatable' AND NOT EXISTS ("
    "SELECT 1 FROM lrun l WHERE l.target_id = s.target_id AND l.migration_id = s.identifier "
    "AND l.checksum = s.checksum AND l.success)))", "skeys", "parsed", "baselines", "ledger", "lrun"))
def plan_report(spark, d):
    """R1 (J1+J2+J7+W3+P9-P11): the numbered pending plan per target."""
    return rp.plan_report(inputs.parsed(spark, d), ledger(spark, d))


_SEQ_FINDINGS_SQL = """
SELECT target_id, 'version_gap' AS "check", 'WARN' AS severity, filename AS subject,
  printf('Version gap detected: expected %d, found Some(%d) in %s', position, version, filename) AS message
FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY version, path) AS position
      FROM skeys WHERE kind = 'versioned') WHERE position <> version
UNION ALL
SELECT target_id, 'duplicate_version', 'WARN', filename, printf('Duplicate version %d found in %s', version, filename)
FROM (SELECT *, row_number() OVER (PARTITION BY target_id, version ORDER BY path) AS occ
      FROM skeys WHERE kind = 'versioned') WHERE occ > 1
UNION ALL
SELECT target_id, 'duplicate_name', 'WARN', filename,
  printf('Duplicate repeatable migration name ''%s'' found in %s', name, filename)
FROM (SELECT *, row_number() OVER (PARTITION BY target_id, name ORDER BY path) AS occ
      FROM skeys WHERE kind = 'repeatable') WHERE occ > 1"""

_LEDGER_FINDINGS_SQL = """
SELECT s.target_id, 'checksum_mismatch' AS "check", 'FAIL' AS severity, s.filename AS subject,
  printf('Checksum mismatch for %s: stored=%s, current=%s', s.filename, l.checksum, s.checksum) AS message
FROM skeys s JOIN lrun l ON l.target_id = s.target_id AND l.migration_id = s.identifier WHERE l.checksum <> s.checksum
UNION ALL
SELECT s.target_id, 'failed', 'FAIL', s.filename, printf('Migration %s failed during application', s.filename)
FROM skeys s JOIN lrun l ON l.target_id = s.target_id AND l.migration_id = s.identifier WHERE NOT l.success
UNION ALL
SELECT l.target_id, 'orphan', 'FAIL', l.filename,
  printf('Migration %s exists in database but corresponding file not found', l.filename)
FROM lrun l WHERE NOT EXISTS (SELECT 1 FROM skeys s WHERE s.target_id = l.target_id AND s.identifier = l.migration_id)"""


@register("union_findings", o.sql(
    f"SELECT * FROM ({_SEQ_FINDINGS_SQL}) UNION ALL SELECT * FROM ({_LEDGER_FINDINGS_SQL})", "skeys", "lrun"))
def union_findings(spark, d):
    """T3 (+P25 messages, W1/W2/A7 on the corpus, J4/J5/F3)."""
    k, led = keys(spark, d), ledger(spark, d)
    return ck.union_findings(ck.sequence_findings(k), ck.ledger_findings(k, led))


@register("validate_report", o.sql(
    "SELECT t.target_id, coalesce(f.errors, 0) AS errors, coalesce(f.checksum_mismatches, 0) AS checksum_mismatches, "
    "coalesce(f.orphans, 0) AS orphans, coalesce(f.warnings, 0) AS warnings, "
    "CASE WHEN coalesce(f.errors, 0) > 0 THEN 'FAILED' ELSE 'PASSED' END AS verdict FROM "
    "targets t LEFT JOIN ("
    "SELECT target_id, count(*) FILTER (WHERE severity = 'FAIL') AS errors, count(*) FILTER (WHERE \"check\" = 'checksum_mismatch') "
    "AS checksum_mismatches, count(*) FILTER (WHERE \"check\" = 'orphan') AS orphans, count(*) FILTER (WHERE severity = 'WARN') AS warnings "
    f"FROM (SELECT * FROM ({_SEQ_FINDINGS_SQL}) UNION ALL SELECT * FROM ({_LEDGER_FINDINGS_SQL})) "
    "GROUP BY target_id) f USING (target_id)", "targets", "skeys", "lrun"))
def validate_report(spark, d):
    """R3 (+A8): per-target summary and verdict."""
    return rp.validate_report(keys(spark, d), ledger(spark, d), b.targets(spark, d))[1]


@register("worst_status", o.sql(
    "SELECT t.target_id, CASE max(CASE severity WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) "
    "WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS status FROM "
    "targets t LEFT JOIN ("
    f"SELECT * FROM ({_SEQ_FINDINGS_SQL}) UNION ALL SELECT * FROM ({_LEDGER_FINDINGS_SQL})) f USING (target_id) "
    "GROUP BY t.target_id", "targets", "skeys", "lrun"))
def worst_status(spark, d):
    """A9."""
    k, led = keys(spark, d), ledger(spark, d)
    return ck.worst_status(ck.union_findings(ck.sequence_findings(k), ck.ledger_findings(k, led)),
                           b.targets(spark, d))


@register("collect_findings", o.sql(
    "SELECT target_id, message, item, count(*) OVER (PARTITION BY target_id) AS items FROM ("
    "SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY message, \"check\", subject) AS item FROM ("
    f"SELECT * FROM ({_SEQ_FINDINGS_SQL}) UNION ALL SELECT * FROM ({_LEDGER_FINDINGS_SQL})))", "skeys", "lrun"))
def collect_findings(spark, d):
    """A10: all messages of a target as one numbered list."""
    k, led = keys(spark, d), ledger(spark, d)
    return ck.numbered_findings(ck.union_findings(ck.sequence_findings(k), ck.ledger_findings(k, led))).select(
        "target_id", "message", "item", "items")


@register("validation_summary", o.sql(
    "SELECT t.target_id, count(*) FILTER (WHERE severity = 'FAIL') AS errors, count(*) FILTER (WHERE \"check\" = 'checksum_mismatch') AS "
    "checksum_mismatches, count(*) FILTER (WHERE \"check\" = 'orphan') AS orphans, "
    "count(*) FILTER (WHERE severity = 'WARN') AS warnings, CASE WHEN count(*) FILTER (WHERE severity = 'FAIL') > 0 "
    "THEN 'FAILED' ELSE 'PASSED' END AS verdict FROM targets t LEFT JOIN ("
    f"SELECT * FROM ({_LEDGER_FINDINGS_SQL})) f USING (target_id) GROUP BY t.target_id", "targets", "skeys", "lrun"))
def validation_summary(spark, d):
    """A8 over the ledger findings, clean targets too."""
    return ck.validation_summary(ck.ledger_findings(keys(spark, d), ledger(spark, d)), b.targets(spark, d))


@register("plan_order", o.sql(
    "SELECT target_id, path, row_number() OVER (PARTITION BY target_id ORDER BY kind = 'repeatable', "
    "version NULLS FIRST, name, path) AS plan_pos FROM skeys s WHERE NOT EXISTS (SELECT 1 FROM lrun l "
    "WHERE l.target_id = s.target_id AND l.migration_id = s.identifier)", "skeys", "lrun"))
def plan_order(spark, d):
    """Numbered plan of the scripts without any ledger row (the plan
    when the ledger holds nothing for them)."""
    k = names(spark, d)
    ids = rc.non_baseline(ledger_names(spark, d)).select("target_id", F.col("migration_id").alias("identifier"))
    todo = k.join(ids, ["target_id", "identifier"], "left_anti").select("target_id", "path", "kind", "version", "name")
    return ordinal(todo, ["target_id"], cp.corpus_order_key(), "plan_pos", at_most=k.count()).select(
        "target_id", "path", "plan_pos")


@register("health_report", o.sql(
    "SELECT target_id, 'Migrations Directory' AS check_name, 'PASS' AS status, "
    "printf('Found %d SQL migration files', n) AS message FROM (SELECT target_id, count(*) AS n FROM scripts "
    "WHERE suffix(path, '.sql') GROUP BY target_id) UNION ALL "
    "SELECT target_id, 'Migration Sequence', CASE WHEN issues = 0 THEN 'PASS' ELSE 'WARN' END, "
    "CASE WHEN issues = 0 THEN printf('%d migrations in correct sequence', n) "
    "ELSE printf('%d sequence issues found', issues) END FROM (SELECT k.target_id, k.n, coalesce(i.issues, 0) AS issues "
    "FROM (SELECT target_id, count(*) AS n FROM skeys GROUP BY target_id) k LEFT JOIN "
    f"(SELECT target_id, count(*) AS issues FROM ({_SEQ_FINDINGS_SQL}) GROUP BY target_id) i USING (target_id)) "
    f"UNION ALL SELECT target_id, 'Sequence Issue', severity, message FROM ({_SEQ_FINDINGS_SQL})",
    "scripts", "skeys"))
def health_report(spark, d):
    """Data checks of the corpus per target (file count, sequence, and
    each issue of the sequence)."""
    return rp.health_report(inputs.names(spark, d))[0]


@register("overall_health", o.sql(
    "SELECT target_id, CASE WHEN issues > 0 THEN 'WARN' ELSE 'PASS' END AS overall FROM ("
    "SELECT k.target_id, coalesce(i.issues, 0) AS issues FROM (SELECT DISTINCT target_id FROM scripts) k LEFT JOIN "
    f"(SELECT target_id, count(*) AS issues FROM ({_SEQ_FINDINGS_SQL}) GROUP BY target_id) i USING (target_id))",
    "scripts", "skeys"))
def overall_health(spark, d):
    """R6 verdict (A9 over the health checks)."""
    return rp.health_report(inputs.names(spark, d))[1]


@register("ledger_create", o.sql(
    "SELECT target_id, migration_id, migration_type, version, filename, checksum, execution_time_ms, success, "
    "applied_at IS NOT NULL AS stamped FROM ledger UNION ALL SELECT target_id, 'noted', 'versioned', NULL, "
    "'noted.sql', 'none', CAST(0 AS BIGINT), false, true FROM targets", "targets", "ledger"))
def ledger_create(spark, d):
    """Create the ledger table (defaults, fixed types) in the shared
    folder, load the fixture ledger into it and one row per target that names
    four columns only, so the defaults fill the rest; read it back.  The table
    leaves the catalog, its files stay for the result."""
    import uuid
    from ..session import scratch_path
    name, path = f"schema_migrations_{uuid.uuid4().hex[:12]}", scratch_path(spark, "ledger_tables")
    lg.create_ledger_table(spark, path, name)
    led = ledger(spark, d)
    led.select(*spark.table(name).columns).write.insertInto(name)
    noted = f"noted_{uuid.uuid4().hex[:12]}"
    b.targets(spark, d).createOrReplaceTempView(noted)
    spark.sql(f"INSERT INTO {name} (target_id, migration_id, filename, checksum) "
              f"SELECT target_id, 'noted', 'noted.sql', 'none' FROM {noted}")
    spark.catalog.dropTempView(noted)
    spark.sql(f"DROP TABLE {name}")
    return lg.read_ledger(spark, path).select(
        "target_id", "migration_id", "migration_type", "version", "filename", "checksum", "execution_time_ms", "success",
        F.col("applied_at").isNotNull().alias("stamped"))


@register("is_applied", o.sql(
    "SELECT s.target_id, s.identifier AS migration_id, coalesce(l.applied_at IS NOT NULL AND l.success, false) "
    "AS is_applied FROM skeys s LEFT JOIN lrun l ON l.target_id = s.target_id AND l.migration_id = s.identifier",
    "skeys", "lrun"))
def is_applied(spark, d):
    """A script counts as applied when its ledger row has a time and succeeded."""
    st = rc.status_join(names(spark, d), ledger_names(spark, d))
    return st.select("target_id", "migration_id", (F.col("status") == "APPLIED").alias("is_applied"))


@register("status_label", o.sql(
    "SELECT target_id, migration_id, tag, status FROM (" + _STATUS_SQL + ")", "skeys", "lrun", "baselines"))
def status_label(spark, d):
    """APPLIED / FAILED / PENDING label and the V/R tag per script."""
    return rc.status_join(names(spark, d), ledger_names(spark, d)).select("target_id", "migration_id", "tag", "status")


@register("finding_message", o.sql(
    f"SELECT target_id, \"check\", message FROM ({_SEQ_FINDINGS_SQL}) UNION ALL "
    f"SELECT target_id, \"check\", message FROM ({_LEDGER_FINDINGS_SQL})", "skeys", "lrun"))
def finding_message(spark, d):
    """P25: the message text of every finding."""
    k, led = keys(spark, d), ledger(spark, d)
    return ck.union_findings(ck.sequence_findings(k), ck.ledger_findings(k, led)).select(
        "target_id", "check", "message")


@register("top_baseline", o.sql(
    "SELECT target_id, migration_id, version, filename FROM (SELECT *, row_number() OVER (PARTITION BY target_id "
    "ORDER BY version DESC, migration_id) AS rn FROM ledger WHERE migration_type = 'baseline') WHERE rn = 1",
    "ledger"))
def top_baseline(spark, d):
    """O3: ORDER BY version DESC LIMIT 1 per target -- a top-1 that Spark
    limits per map task (WindowGroupLimit) before the shuffle."""
    from pyspark.sql import Window
    b_ = inputs.baselines(spark, d)
    w = Window.partitionBy("target_id").orderBy(F.col("version").desc(), F.col("migration_id"))
    return (b_.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
            .select("target_id", "migration_id", "version", "filename"))


@register("version_gaps_first", o.sql(
    "SELECT target_id, version, position FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY version) "
    "AS position FROM seq) p WHERE position <> version AND position = (SELECT min(q.position) FROM ("
    "SELECT target_id, version, row_number() OVER (PARTITION BY target_id ORDER BY version) AS position FROM seq) q "
    "WHERE q.target_id = p.target_id AND q.position <> q.version)", "seq"))
def version_gaps_first(spark, d):
    """W1 variant: only the first gap of each target."""
    pos = ck.version_positions(b.seq(spark, d))
    return ck.first_gap_only(pos).select("target_id", "version", "position")
