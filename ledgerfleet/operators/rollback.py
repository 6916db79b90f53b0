"""Rollback and baseline planning.

Rollback candidates are successful versioned rows (F2), newest first.
``Steps(n)`` keeps the newest n per target: a ``row_number() <= n`` filter,
which Spark turns into a partial WindowGroupLimit before the shuffle, so each
map task ships at most n rows per target however hot the target.
``ToVersion(t)`` keeps every version above t (strict, SURVEY Q20) and numbers
them with the skew-proof ``ordinal``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scripts as fs
from ..sources.ledger import rollbackable
from .joins import per_target_join
from .reconcile import latest_runs
from .scan import freeze, ordinal

# --- fixed values: rollback / baseline texts ----------------------------------
MSG_NO_DOWN = "Migration %s cannot be rolled back: no rollback SQL found"
MSG_NO_FILE = "Migration error: Migration file not found for version %d"
MSG_BAD_TARGET = "Cannot rollback to version %d: migration not found or not applied"
MSG_BASELINE_CONFLICT = ("Cannot create baseline version %d - conflicting migrations exist at or above "
                         "this version")
MSG_BASELINE_EXISTS = "Baseline version %d already exists"
# --------------------------------------------------------------------------------


def _order():
    return [F.col("version").desc(), F.col("migration_id")]


def plan_steps(ledger: DataFrame, steps: int) -> DataFrame:
    """O4 + W4: newest ``steps`` successful versioned rows per target, with
    ``rollback_order`` (1 = newest) and ``rollback_total`` (fewer than asked
    when the target has fewer)."""
    w = Window.partitionBy("target_id").orderBy(*_order())
    top = (rollbackable(ledger).withColumn("rollback_order", F.row_number().over(w).cast("long"))
           .where(F.col("rollback_order") <= steps))
    total = top.groupBy("target_id").agg(F.count(F.lit(1)).alias("rollback_total"))
    return top.join(total, "target_id")


def plan_to_version(ledger: DataFrame, target_version: int) -> DataFrame:
    """F6 + W4: all successful versioned rows above ``target_version``."""
    r = freeze(rollbackable(ledger).where(F.col("version") > F.lit(target_version)))
    out = ordinal(r, ["target_id"], _order(), "rollback_order")
    total = r.groupBy("target_id").agg(F.count(F.lit(1)).alias("rollback_total"))
    return per_target_join(out, total, ["target_id"], "inner", spread_by=["migration_id"])


def check_plan(plan: DataFrame, scripts: DataFrame) -> DataFrame:
    """Each planned row against the script of its version: MISSING_FILE,
    NO_DOWN or OK, with the reference's message."""
    by_version = (scripts.where(F.col("kind") == "versioned").groupBy("target_id", "version")
                  .agg(F.max_by("has_rollback", "path").alias("has_rollback")))
    j = plan.join(by_version, ["target_id", "version"], "left")
    status = (F.when(F.col("has_rollback").isNull(), F.lit("MISSING_FILE"))
              .when(~F.col("has_rollback"), F.lit("NO_DOWN")).otherwise(F.lit("OK")))
    msg = (F.when(F.col("has_rollback").isNull(), F.format_string(MSG_NO_FILE, F.col("version")))
           .when(~F.col("has_rollback"), F.format_string(MSG_NO_DOWN, F.col("filename"))))
    return j.withColumn("check_status", status).withColumn("message", msg).drop("has_rollback")


def plan_summary(checked: DataFrame, targets: DataFrame, strategy: str, target_version: int | None = None) -> DataFrame:
    """R4 verdict per target: the first failing row in rollback order decides
    (the reference stops at the first error); ToVersion with nothing above
    the target is INVALID_TARGET, Steps with nothing is EMPTY (a success)."""
    errs = (checked.where(F.col("check_status") != "OK").groupBy("target_id")
            .agg(F.min_by(F.struct("check_status", "message"), F.col("rollback_order")).alias("e")))
    n = checked.groupBy("target_id").agg(F.count(F.lit(1)).alias("rollback_total"))
    out = targets.select("target_id").distinct().join(n, "target_id", "left").join(errs, "target_id", "left")
    empty = F.coalesce(F.col("rollback_total"), F.lit(0)) == 0
    if strategy == "to_version":
        status = F.when(empty, F.lit("INVALID_TARGET"))
        message = F.when(empty, F.format_string(MSG_BAD_TARGET, F.lit(target_version)))
    else:
        status = F.when(empty, F.lit("EMPTY"))
        message = F.when(empty, F.lit(None).cast("string"))
    status = status.when(F.col("e").isNotNull(), F.col("e.check_status")).otherwise(F.lit("OK"))
    message = message.when(F.col("e").isNotNull(), F.col("e.message"))
    return out.select("target_id", F.lit(strategy).alias("strategy"),
                      F.coalesce(F.col("rollback_total"), F.lit(0)).cast("long").alias("rollback_total"),
                      status.alias("status"), message.alias("message"))


def baselines_asc(ledger: DataFrame) -> DataFrame:
    """Every baseline row per target, numbered by version."""
    b = ledger.where(F.col("migration_type") == "baseline")
    return ordinal(b, ["target_id"], [F.col("version"), F.col("migration_id")], "baseline_pos")


def would_skip(scripts: DataFrame, proposals: DataFrame) -> DataFrame:
    """The versioned scripts at or below their target's proposed baseline."""
    v = scripts.where(F.col("kind") == "versioned").select("target_id", "path", "version")
    return (per_target_join(v, proposals, ["target_id"], "inner", spread_by=["path"])
            .where(F.col("version") <= F.col("new_baseline")))


def baseline_plan(ledger: DataFrame, proposals: DataFrame, description: str, at: str,
                  scripts: DataFrame | None = None) -> DataFrame:
    """R5 + L5 + F5: per target, the proposed baseline (target_id,
    new_baseline) is refused when a run at or above it exists (conflict) or
    the same baseline exists; otherwise the row to append.  Also counts the
    existing runs and, of ``scripts``, those the baseline would skip (their
    list is ``would_skip``)."""
    runs = latest_runs(ledger)
    j = per_target_join(runs, proposals, ["target_id"], "inner", spread_by=["migration_id"])
    conflicts = (j.groupBy("target_id").agg(
        F.count(F.lit(1)).alias("existing_runs"),
        F.count_if(F.col("version") >= F.col("new_baseline")).alias("conflicts")))
    existing = (ledger.where(F.col("migration_type") == "baseline").select("target_id", "version")
                .distinct().withColumnRenamed("version", "new_baseline").withColumn("exists", F.lit(True)))
    p = (proposals.join(conflicts, "target_id", "left").join(existing, ["target_id", "new_baseline"], "left"))
    if scripts is not None:
        p = p.join(would_skip(scripts, proposals).groupBy("target_id").agg(F.count(F.lit(1)).alias("skips")), "target_id", "left")
    else:
        p = p.withColumn("skips", F.lit(None).cast("long"))
    status = (F.when(F.coalesce("conflicts", F.lit(0)) > 0, F.lit("CONFLICT"))
              .when(F.coalesce("exists", F.lit(False)), F.lit("EXISTS")).otherwise(F.lit("CREATE")))
    msg = (F.when(status == "CONFLICT", F.format_string(MSG_BASELINE_CONFLICT, F.col("new_baseline")))
           .when(status == "EXISTS", F.format_string(MSG_BASELINE_EXISTS, F.col("new_baseline"))))
    return p.select(
        "target_id", F.col("new_baseline").alias("version"),
        F.coalesce("existing_runs", F.lit(0)).cast("long").alias("existing_runs"),
        F.coalesce("conflicts", F.lit(0)).cast("long").alias("conflicts"),
        F.coalesce("skips", F.lit(0)).cast("long").alias("would_skip"),
        status.alias("status"), msg.alias("message"),
        fs.baseline_filename(F.col("new_baseline"), F.lit(description)).alias("filename"),
        F.lit(at).cast("timestamp_ntz").alias("applied_at"))


def baseline_rows(plan: DataFrame) -> DataFrame:
    """Ledger rows to append for the accepted baselines."""
    ok = plan.where(F.col("status") == "CREATE")
    return ok.select("target_id", F.col("version").cast("string").alias("migration_id"),
                     F.lit("baseline").alias("migration_type"), "version", "filename",
                     F.lit("baseline").alias("checksum"), "applied_at",
                     F.lit(0).cast("long").alias("execution_time_ms"), F.lit(True).alias("success"))
