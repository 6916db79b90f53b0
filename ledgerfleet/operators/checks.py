"""Sequence checks, findings and their summaries.

Positions inside a target come from ``scan.ordinal`` so a hot target is
spread over many tasks; counts are plain grouped aggregates (map-side
partial aggregation keeps them skew-proof).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import SEVERITY_RANK
from . import reconcile as rc
from .joins import per_target_join
from .scan import freeze, ordinal

# --- fixed values: finding texts -------------------------------------------
MSG_GAP = "Version gap detected: expected %d, found Some(%d) in %s"
MSG_DUP_VERSION = "Duplicate version %d found in %s"
MSG_DUP_NAME = "Duplicate repeatable migration name '%s' found in %s"
MSG_DRIFT = "Checksum mismatch for %s: stored=%s, current=%s"
MSG_FAILED = "Migration %s failed during application"
MSG_MARKER = "Marker '-- UP' of %s is part of a longer comment"
MSG_TIME = "Timestamp '%s' of migration %s cannot be read"
MSG_ORPHAN = "Migration %s exists in database but corresponding file not found"
# ---------------------------------------------------------------------------


BITS = 1 << 15                # versions of one bitmap (Spark's bitmap functions)
HEAVY_VERSION = 1_000_000     # files of one version beyond which their order is made in slices


def _bits_before(bitmap: str, bit: str) -> str:
    """How many bits below ``bit`` are set: whole bytes, then part of one."""
    last = f"cast(conv(hex(substring({bitmap}, {bit} div 8 + 1, 1)), 16, 10) as int)"
    return f"(bitmap_count(substring({bitmap}, 1, {bit} div 8)) + bit_count({last} & (shiftleft(1, {bit} % 8) - 1)))"


def version_positions(df: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """W1 input: 1-based position of each versioned row inside its target,
    ordered by version then ``tie``; ``is_gap`` when position != version
    (SURVEY Q8: one gap flags every later row, sequences start at 1).

    Nothing is sorted for it: the versions of a target stand in bitmaps of 32768
    (``bitmap_construct_agg``, map-side first), of which it has at most 2**17, and
    a position is the rows of the earlier bitmaps plus the bits set before its
    own.  Versions that occur more than once are counted apart: what they add to
    later positions is a list of their bitmap, and only their own rows are numbered by
    ``tie`` (in slices for a version of more than ``HEAVY_VERSION`` files)."""
    columns, place = df.columns, ["target_id", "_b"]
    rows = df.withColumns({"_b": F.shiftright("version", 15), "_bit": F.col("version").bitwiseAND(BITS - 1).cast("int")})
    maps = rows.groupBy(*place).agg(F.bitmap_construct_agg("_bit").alias("_map"), F.count(F.lit(1)).alias("_n"))
    doubled = maps.where(F.col("_n") > F.bitmap_count("_map")).select(*place)
    often = (rows.join(doubled, place, "left_semi").groupBy(*place, "_bit").agg(F.count(F.lit(1)).alias("_k"))
             .where(F.col("_k") > 1).groupBy(*place)
             .agg(F.collect_list(F.struct("_bit", (F.col("_k") - 1).alias("more"))).alias("_often")))
    earlier = Window.partitionBy("target_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    placed = (maps.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
              .join(often, place, "left"))
    out = rows.join(placed, place).withColumns({
        "_more": F.expr("coalesce(get(filter(_often, x -> x._bit = _bit), 0).more, 0)"),
        "position": F.expr(f"_before + {_bits_before('_map', '_bit')} + 1 + coalesce(aggregate(filter(_often, x -> x._bit < _bit), "
                           "0L, (n, x) -> n + x.more), 0L)")})
    once = out.where(F.col("_more") == 0)
    twice = out.where((F.col("_more") > 0) & (F.col("_more") < HEAVY_VERSION))
    order = [F.col(c) for c in (tie or ["version"])]
    in_version = F.row_number().over(Window.partitionBy("target_id", "version").orderBy(*order))
    twice = twice.withColumn("position", F.col("position") + in_version - 1)
    kept = [*columns, F.col("position").cast("long").alias("position")]
    out_rows = once.select(*kept).unionByName(twice.select(*kept))
    heavy = rows.join(often.select(*place, F.explode("_often").alias("o")).where(F.col("o.more") >= HEAVY_VERSION)
                      .select(*place, "o._bit"), [*place, "_bit"], "left_semi")
    if not heavy.isEmpty():
        numbered = ordinal(out.where(F.col("_more") >= HEAVY_VERSION).select(*columns, "position"), ["target_id", "version"],
                           order, "_in_version")
        out_rows = out_rows.unionByName(numbered.withColumn("position", F.col("position") + F.col("_in_version") - 1)
                                        .select(*columns, "position"))
    return out_rows.withColumn("is_gap", F.col("position") != F.col("version"))


def first_gap_only(positions: DataFrame) -> DataFrame:
    """Variant of W1 that reports only the first gap per target."""
    first = (positions.where(F.col("is_gap")).groupBy("target_id")
             .agg(F.min("position").alias("position")))
    return positions.join(first, ["target_id", "position"], "left_semi")


def later_duplicates(df: DataFrame, key: str, tie: list[str] | None = None) -> DataFrame:
    """Occurrence number of each row among rows of the same target and
    ``key``; ``is_later_duplicate`` for the second and later ones."""
    order = [F.col(c) for c in (tie or [key])]
    out = ordinal(df, ["target_id", key], order, "occurrence")
    return out.withColumn("is_later_duplicate", F.col("occurrence") > 1)


def later_copies(df: DataFrame, key: str, tie: str) -> DataFrame:
    """Rows that are not the first of their (target, key) group by ``tie``:
    the W2 flag without numbering.  The first ``tie`` of a group with two or more
    rows is a partially aggregated ``min``; equal rows are counted, and all but
    one of the first's stay."""
    groups = (df.groupBy("target_id", key).agg(F.min(tie).alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    rows = (df.join(groups, ["target_id", key]).groupBy(*df.columns, (F.col(tie) == F.col("_first")).alias("_is_first"))
            .agg(F.count(F.lit(1)).alias("_n")))
    later = F.col("_n") - F.col("_is_first").cast("long")
    return rows.where(later > 0).select(*df.columns, F.explode(F.sequence(F.lit(1), later)).alias("_k")).drop("_k")


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once per target, with their count."""
    return (df.groupBy("target_id", key).agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def count_by_kind(scripts: DataFrame) -> DataFrame:
    """A1 (+A11): versioned / repeatable / all-file counts per target."""
    return scripts.groupBy("target_id").agg(
        F.count(F.lit(1)).alias("sql_files"),
        F.count_if(F.col("kind") == "versioned").alias("versioned"),
        F.count_if(F.col("kind") == "repeatable").alias("repeatable"),
        F.count_if(F.col("kind") == "invalid").alias("invalid"))


# Sequence issues stop an apply; the other reports only warn.
SEQUENCE_SEVERITY = {"apply": "FAIL"}


def sequence_findings(scripts: DataFrame, report: str = "validate") -> DataFrame:
    """Gap, duplicate-version and duplicate-name findings of a parsed corpus
    (the reference's sequence validator), with the severity they have in
    ``report`` (apply, status, validate or health)."""
    v = scripts.where(F.col("kind") == "versioned").select("target_id", "version", "filename", "path")
    gaps = (version_positions(v, ["path"]).where("is_gap")
            .select("target_id", F.lit("version_gap").alias("check"), F.col("filename").alias("subject"),
                    F.format_string(MSG_GAP, F.col("position"), F.col("version"), F.col("filename"))
                    .alias("message")))
    dups = (later_copies(v, "version", "path")
            .select("target_id", F.lit("duplicate_version").alias("check"), F.col("filename").alias("subject"),
                    F.format_string(MSG_DUP_VERSION, F.col("version"), F.col("filename")).alias("message")))
    r = scripts.where(F.col("kind") == "repeatable").select("target_id", "name", "filename", "path")
    names = (later_copies(r, "name", "path")
             .select("target_id", F.lit("duplicate_name").alias("check"), F.col("filename").alias("subject"),
                     F.format_string(MSG_DUP_NAME, F.col("name"), F.col("filename")).alias("message")))
    severity = SEQUENCE_SEVERITY.get(report, "WARN")
    return gaps.unionByName(dups).unionByName(names).withColumn("severity", F.lit(severity))


def apply_gate(scripts: DataFrame) -> DataFrame:
    """Q9: targets whose scripts have sequence issues; nothing is applied there."""
    return sequence_findings(scripts, "apply").where(F.col("severity") == "FAIL").select("target_id").distinct()


def marker_findings(scripts: DataFrame) -> DataFrame:
    """Q3: scripts (with ``body``) whose Up marker was found inside a longer
    comment such as '-- update the table'."""
    from ..functions import scripts as fs
    p = scripts.where((F.col("marker_style") == 2) & fs.marker_in_comment("body"))
    return p.select("target_id", F.lit("marker_in_comment").alias("check"), F.col("path").alias("subject"),
                    F.format_string(MSG_MARKER, F.col("path")).alias("message"), F.lit("WARN").alias("severity"))


def unreadable_times(ledger_text: DataFrame) -> DataFrame:
    """Q14: ledger rows in text form whose time is there but cannot be read."""
    from ..functions import decode as dc
    bad = ledger_text.where((F.col("applied_at") != "NULL") & dc.decode_timestamp("applied_at").isNull())
    return bad.select("target_id", F.lit("unreadable_time").alias("check"), F.col("migration_id").alias("subject"),
                      F.format_string(MSG_TIME, F.col("applied_at"), F.col("migration_id")).alias("message"),
                      F.lit("WARN").alias("severity"))


def ledger_findings(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Drift, failed and orphan findings (the reference's validate), FAIL.
    One full outer join of scripts and ledger runs rows (not baselines)
    yields all three; each joined row explodes into its 0-2 findings."""
    s = scripts.select("target_id", F.col("identifier").alias("migration_id"), "filename", "checksum",
                       F.lit(True).alias("_s"))
    led = rc.latest_runs(ledger).select("target_id", "migration_id", F.col("filename").alias("l_filename"),
                                         F.col("checksum").alias("stored_checksum"), "success",
                                         F.lit(True).alias("_l"))
    j = s.join(led, ["target_id", "migration_id"], "full_outer")
    both = F.col("_s").isNotNull() & F.col("_l").isNotNull()

    def item(cond, check, subject, message):
        return F.when(cond, F.struct(F.lit(check).alias("check"), subject.alias("subject"), message.alias("message")))

    items = F.array(
        item(both & (F.col("stored_checksum") != F.col("checksum")), "checksum_mismatch", F.col("filename"),
             F.format_string(MSG_DRIFT, F.col("filename"), F.col("stored_checksum"), F.col("checksum"))),
        item(both & ~F.col("success"), "failed", F.col("filename"), F.format_string(MSG_FAILED, F.col("filename"))),
        item(F.col("_s").isNull(), "orphan", F.col("l_filename"), F.format_string(MSG_ORPHAN, F.col("l_filename"))))
    return (j.select("target_id", F.explode(F.filter(items, lambda x: x.isNotNull())).alias("f"))
            .select("target_id", "f.check", "f.subject", "f.message")
            .withColumn("severity", F.lit("FAIL")))


def union_findings(*parts: DataFrame) -> DataFrame:
    """One findings relation (target_id, check, severity, subject, message)."""
    cols = ["target_id", "check", "severity", "subject", "message"]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*cols) for p in parts])


def validation_summary(findings: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target: errors, checksum mismatches, orphans, warnings and
    the verdict (failed when any drift, failed run or orphan exists)."""
    agg = findings.groupBy("target_id").agg(
        F.count_if(F.col("severity") == "FAIL").alias("errors"),
        F.count_if(F.col("check") == "checksum_mismatch").alias("checksum_mismatches"),
        F.count_if(F.col("check") == "orphan").alias("orphans"),
        F.count_if(F.col("severity") == "WARN").alias("warnings"))
    out = targets.select("target_id").distinct().join(agg, "target_id", "left")
    for c in ("errors", "checksum_mismatches", "orphans", "warnings"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("long"))
    return out.withColumn("verdict", F.when(F.col("errors") > 0, F.lit("FAILED")).otherwise(F.lit("PASSED")))


def worst_status(findings: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target the worst severity, Fail > Warn > Pass; a target
    without findings passes."""
    rank = F.lit(0)
    for name, r in SEVERITY_RANK.items():
        rank = F.when(F.col("severity") == name, F.lit(r)).otherwise(rank)
    back = F.lit("PASS")
    for name, r in SEVERITY_RANK.items():
        back = F.when(F.col("worst_rank") == r, F.lit(name)).otherwise(back)
    worst = findings.groupBy("target_id").agg(F.max(rank).alias("worst_rank"))
    return (targets.select("target_id").distinct().join(worst, "target_id", "left")
            .withColumn("status", back).drop("worst_rank"))


def numbered_findings(findings: DataFrame) -> DataFrame:
    """A10: the findings of a target as one ordered list -- kept as rows
    (item i of n, ordered by message) instead of one concatenated string, so
    a target with millions of findings is never gathered into one value."""
    findings = freeze(findings)      # numbered and counted: computed once
    out = ordinal(findings, ["target_id"], [F.col("message"), F.col("check"), F.col("subject")], "item")
    n = findings.groupBy("target_id").agg(F.count(F.lit(1)).alias("items"))
    return per_target_join(out, n, ["target_id"], "inner", spread_by=["item"])


def applied_matches_corpus(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per target, successful ledger rows against script files."""
    applied = (rc.latest_runs(ledger).where("success").groupBy("target_id")
               .agg(F.count(F.lit(1)).alias("applied")))
    files = scripts.groupBy("target_id").agg(F.count(F.lit(1)).alias("files"))
    return (files.join(applied, "target_id", "full_outer")
            .select("target_id", F.coalesce("files", F.lit(0)).cast("long").alias("files"),
                    F.coalesce("applied", F.lit(0)).cast("long").alias("applied"))
            .withColumn("matches", F.col("files") == F.col("applied")))
