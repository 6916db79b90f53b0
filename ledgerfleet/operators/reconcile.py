"""Scripts against the ledger, for every target at once.

The reference answers these with one point query per script; here each is a
single equi-join on (target_id, migration_id) or (target_id, version).  Those
keys are nearly unique, so hash partitioning spreads a hot target evenly.
Only the baseline (one row per target) is joined on target_id alone, through
``per_target_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scripts as fs
from .joins import per_target_join


def non_baseline(ledger: DataFrame) -> DataFrame:
    """Ledger rows that stand for script runs (SURVEY Q10/Q11: a baseline row
    never matches a script and never counts as drift or orphan)."""
    return ledger.where(F.col("migration_type") != "baseline")


def latest_runs(ledger: DataFrame) -> DataFrame:
    """The ledger a report sees: of the rows of one id (a failed
    run and its retries) the latest by time; a success wins a tie.  Ids are
    nearly unique, and the same partitioning serves the join that follows."""
    latest = Window.partitionBy("target_id", "migration_id").orderBy(
        F.col("applied_at").desc(), F.col("success").desc(), F.col("execution_time_ms").desc(), F.col("filename"))
    return (non_baseline(ledger).withColumn("_rn", F.row_number().over(latest))
            .where(F.col("_rn") == 1).drop("_rn"))


def baseline_version(ledger: DataFrame) -> DataFrame:
    """A4 / O3: highest baseline per target."""
    return (ledger.where(F.col("migration_type") == "baseline")
            .groupBy("target_id").agg(F.max("version").alias("baseline_version")))


def successful_versions(ledger: DataFrame) -> DataFrame:
    """Distinct (target, version) with a successful versioned row (A5)."""
    return (ledger.where((F.col("migration_type") == "versioned") & F.col("success"))
            .select("target_id", "version").distinct())


def with_baseline(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Attach the target's baseline and a ``below_baseline`` flag
    (versioned scripts at or below it; repeatables never, SURVEY Q23)."""
    out = per_target_join(scripts, baseline_version(ledger), ["target_id"], "left",
                          spread_by=["path"])
    return out.withColumn("below_baseline", F.coalesce(
        (F.col("kind") == "versioned") & (F.col("version") <= F.col("baseline_version")), F.lit(False)))


def pending_versioned(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """J1 (+F4/J7): versioned scripts above the baseline with no successful
    ledger row of the same version."""
    v = with_baseline(scripts.where(F.col("kind") == "versioned"), ledger)
    return (v.where(~F.col("below_baseline"))
            .join(successful_versions(ledger), ["target_id", "version"], "left_anti"))


def pending_repeatable(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Repeatables never run successfully, or whose stored checksum of a
    successful run differs from the file's."""
    ok = (latest_runs(ledger).where("success")
          .select("target_id", F.col("migration_id").alias("identifier"), "checksum").distinct())
    return (scripts.where(F.col("kind") == "repeatable")
            .join(ok, ["target_id", "identifier", "checksum"], "left_anti"))


def pending(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """J1 union J2, the reference's pending set."""
    cols = scripts.columns
    return pending_versioned(scripts, ledger).select(*cols).unionByName(
        pending_repeatable(scripts, ledger).select(*cols))


def _ledger_side(ledger: DataFrame) -> DataFrame:
    return latest_runs(ledger).select(
        "target_id", "migration_id", "migration_type", F.col("version").alias("l_version"),
        F.col("filename").alias("l_filename"), F.col("checksum").alias("stored_checksum"),
        "applied_at", "execution_time_ms", "success")


def status_join(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """J3 + P18 + P21: every script with its ledger row, label and drift flag."""
    s = scripts.withColumnRenamed("identifier", "migration_id")
    j = s.join(_ledger_side(ledger), ["target_id", "migration_id"], "left")
    matched = F.col("migration_type").isNotNull()
    out = (j.withColumn("status", fs.status_label("applied_at", "success", matched))
            .withColumn("tag", fs.kind_tag("kind")))
    if "checksum" not in scripts.columns:      # the name layer knows no drift
        return out
    return out.withColumn("checksum_mismatch", matched & (F.col("stored_checksum") != F.col("checksum")))


def orphans(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows (not baselines) with no script of the same id."""
    ids = scripts.select("target_id", F.col("identifier").alias("migration_id"))
    return latest_runs(ledger).join(ids, ["target_id", "migration_id"], "left_anti")


def checksum_drift(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Matched rows whose stored checksum differs from the file's."""
    s = scripts.withColumnRenamed("identifier", "migration_id")
    return (s.join(_ledger_side(ledger), ["target_id", "migration_id"], "inner")
             .where(F.col("stored_checksum") != F.col("checksum")))


def joined(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """J8's join: every script and every latest run, matched by id."""
    s = scripts.select("target_id", F.col("identifier").alias("migration_id"), "kind", "version",
                       "filename", "checksum")
    return s.join(_ledger_side(ledger), ["target_id", "migration_id"], "full_outer")


def with_state(j: DataFrame, *more: str) -> DataFrame:
    """J8's rows from ``joined`` ones (and their columns ``more``)."""
    has_s, has_l = F.col("kind").isNotNull(), F.col("migration_type").isNotNull()
    state = (F.when(~has_l, F.lit("PENDING"))
             .when(~has_s, F.lit("ORPHAN"))
             .when(~(F.col("applied_at").isNotNull() & F.col("success")), F.lit("FAILED"))
             .when(F.col("stored_checksum") != F.col("checksum"), F.lit("DRIFT"))
             .otherwise(F.lit("APPLIED")))
    return j.select("target_id", "migration_id",
                    F.coalesce("kind", "migration_type").alias("kind"),
                    F.coalesce("version", "l_version").alias("version"),
                    F.coalesce("filename", "l_filename").alias("filename"),
                    state.alias("state"), F.col("checksum").alias("current_checksum"),
                    "stored_checksum", "applied_at", "execution_time_ms", "success", *more)


def reconcile(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Scripts full-outer-join ledger with one state per row:
    PENDING (file only), ORPHAN (ledger only), FAILED (run not successful),
    DRIFT (checksum changed after the run), APPLIED.  ``incremental`` keeps it up
    to date."""
    return with_state(joined(scripts, ledger))


def status_counts(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """A2 (+A3 max, A4): per target total / applied / pending / failed /
    skipped counts, counted from the join (SURVEY Q13 fix), with the latest
    applied version and the baseline."""
    st = with_baseline(status_join(scripts, ledger), ledger)
    per_t = st.groupBy("target_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "APPLIED").alias("applied"),
        F.count_if((F.col("status") == "PENDING") & ~F.col("below_baseline")).alias("pending"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("below_baseline")).alias("skipped"),
        F.count_if(F.col("checksum_mismatch")).alias("checksum_mismatches"))
    latest = (ledger.where((F.col("migration_type") == "versioned") & F.col("success"))
              .groupBy("target_id").agg(F.max("version").alias("latest_version")))
    failed_rows = (ledger.where(~F.col("success")).groupBy("target_id")
                   .agg(F.count(F.lit(1)).alias("failed_ledger_rows")))
    return (per_t.join(latest, "target_id", "left").join(baseline_version(ledger), "target_id", "left")
                 .join(failed_rows, "target_id", "left")
                 .withColumn("failed_ledger_rows", F.coalesce("failed_ledger_rows", F.lit(0)).cast("long")))


def stored_checksum(ledger: DataFrame, ids: DataFrame) -> DataFrame:
    """Checksum by id (its latest row), any status; ``ids`` holds
    (target_id, migration_id)."""
    return ids.join(latest_runs(ledger).select("target_id", "migration_id", "checksum"),
                    ["target_id", "migration_id"], "left")


def is_applied(scripts: DataFrame, ledger: DataFrame) -> DataFrame:
    """A5: per versioned script, whether a successful run of its version
    exists (``COUNT(*) > 0``), and whether its version is a baseline."""
    ok = successful_versions(ledger).withColumn("is_applied", F.lit(True))
    base = (ledger.where(F.col("migration_type") == "baseline").select("target_id", "version").distinct()
            .withColumn("is_baseline", F.lit(True)))
    v = scripts.where(F.col("kind") == "versioned").select("target_id", "path", "version")
    return (v.join(ok, ["target_id", "version"], "left").join(base, ["target_id", "version"], "left")
             .select("target_id", "path", "version",
                     F.coalesce("is_applied", F.lit(False)).alias("is_applied"),
                     F.coalesce("is_baseline", F.lit(False)).alias("is_baseline")))
