"""User-level reports (R1-R3, R5, R6): compositions of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scripts as fs
from ..operators import checks as ck
from ..operators import corpus as cp
from ..operators import reconcile as rc
from ..operators.scan import freeze, ordinal


def status_report(keys: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """R2: every script with its label (APPLIED / FAILED / PENDING), run time,
    drift flag and whether the baseline skips it.  Without a ledger table
    every script is pending."""
    if ledger is None:
        return keys.select(
            "target_id", F.col("identifier").alias("migration_id"), "path", fs.kind_tag("kind").alias("tag"), "filename",
            F.lit("PENDING").alias("status"), F.lit(None).cast("timestamp_ntz").alias("applied_at"),
            F.lit(None).cast("long").alias("execution_time_ms"), F.lit(False).alias("checksum_mismatch"),
            F.lit(False).alias("below_baseline"))
    st = rc.with_baseline(rc.status_join(keys, ledger), ledger)
    return st.select("target_id", "migration_id", "path", "tag", "filename", "status", "applied_at",
                     "execution_time_ms", "checksum_mismatch", "below_baseline")


def plan_report(parsed: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Pending scripts per target in apply order, numbered, with type,
    line count, checksum prefix and a short preview.  The preview is cut in
    the scan stage so no script text crosses a shuffle.  Without a ledger
    every valid script is pending."""
    if "preview" not in parsed.columns:
        parsed = (parsed.withColumn("preview", fs.preview("up_sql"))
                        .withColumn("preview_more", fs.preview_truncated("up_sql")))
    narrow = cp.valid_scripts(parsed).select(*cp.KEY_COLUMNS, "preview", "preview_more")
    todo = narrow if ledger is None else rc.pending(narrow, ledger)
    # what is pending is a part of the corpus, whose rows are frozen
    todo = (todo.withColumn("tag", fs.kind_tag("kind"))
                .withColumn("checksum8", fs.checksum_prefix("checksum")))
    out = ordinal(todo, ["target_id"], [*cp.corpus_order_key(), F.col("checksum")], "plan_pos",
                  at_most=narrow.count())
    return out.select("target_id", "path", "filename", "version", "tag", "line_count", "checksum8",
                      "preview", "preview_more", "plan_pos")


def validate_files(keys: DataFrame) -> DataFrame:
    """R3 without a ledger table: per target the script counts, and per
    script type, line count and checksum prefix are columns of the corpus."""
    return keys.groupBy("target_id").agg(
        F.count(F.lit(1)).alias("migrations"), F.count_if(F.col("kind") == "versioned").alias("versioned"),
        F.count_if(F.col("kind") == "repeatable").alias("repeatable"), F.sum("line_count").alias("lines"))


def validate_report(keys: DataFrame, ledger: DataFrame | None, targets: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(findings, per-target summary with verdict).  Without a ledger
    table only the sequence is checked.  ``targets`` lists those to report on
    (by default those with a script or a run)."""
    if ledger is None:
        findings = freeze(ck.sequence_findings(keys))
        return findings, ck.validation_summary(findings, keys if targets is None else targets)
    findings = ck.union_findings(ck.sequence_findings(keys), ck.ledger_findings(keys, ledger))
    if targets is None:
        targets = keys.select("target_id").unionByName(rc.non_baseline(ledger).select("target_id")).distinct()
    return findings, ck.validation_summary(findings, targets)


def _counted(report: DataFrame, counters: dict) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return report.observe(seen, *[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in counters.items()]), seen


def observed_status(report: DataFrame) -> tuple[DataFrame, Observation]:
    """R2 with the fleet's A1 and A2 counters from the same pass: the counters
    are in ``Observation.get`` once the returned report has been written or
    collected.  Spark counts them in the tasks that hand out the report, so write
    it as it is: behind a further shuffle a lost stage could be counted twice, and
    a limit would stop the count."""
    status, kind = F.col("status"), F.col("tag")
    return _counted(report, {
        "total": F.count(F.lit(1)),
        "versioned": F.count_if(kind == fs.kind_tag(F.lit("versioned"))),
        "repeatable": F.count_if(kind == fs.kind_tag(F.lit("repeatable"))),
        "applied": F.count_if(status == "APPLIED"), "failed": F.count_if(status == "FAILED"),
        "pending": F.count_if((status == "PENDING") & ~F.col("below_baseline")),
        "skipped": F.count_if(F.col("below_baseline")),
        "checksum_mismatches": F.count_if(F.col("checksum_mismatch"))})


def observed_findings(findings: DataFrame) -> tuple[DataFrame, Observation]:
    """R3's findings with the fleet's A8 counters from the same pass (as
    ``observed_status``); the fleet fails where ``errors`` is above 0 (A9)."""
    severity, check = F.col("severity"), F.col("check")
    return _counted(findings, {
        "findings": F.count(F.lit(1)), "errors": F.count_if(severity == "FAIL"),
        "checksum_mismatches": F.count_if(check == "checksum_mismatch"), "orphans": F.count_if(check == "orphan"),
        "warnings": F.count_if(severity == "WARN")})


def health_report(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per target 'Migrations Directory' (file count) and 'Migration
    Sequence' checks, one 'Sequence Issue' row per issue, and the overall
    status (A9).  Needs the name layer only."""
    files = (parsed.where(F.col("path").endswith(".sql")).groupBy("target_id")
             .agg(F.count(F.lit(1)).alias("n")))
    dir_check = files.select("target_id", F.lit("Migrations Directory").alias("check_name"),
                             F.lit("PASS").alias("status"),
                             F.format_string("Found %d SQL migration files", F.col("n")).alias("message"))
    keys = cp.valid_scripts(parsed)
    found = freeze(ck.sequence_findings(keys))
    issues = found.groupBy("target_id").agg(F.count(F.lit(1)).alias("issues"))
    loaded = keys.groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    seq = loaded.join(issues, "target_id", "left").withColumn("issues", F.coalesce("issues", F.lit(0)))
    seq_check = seq.select(
        "target_id", F.lit("Migration Sequence").alias("check_name"),
        F.when(F.col("issues") == 0, F.lit("PASS")).otherwise(F.lit("WARN")).alias("status"),
        F.when(F.col("issues") == 0, F.format_string("%d migrations in correct sequence", F.col("n")))
         .otherwise(F.format_string("%d sequence issues found", F.col("issues"))).alias("message"))
    each = found.select("target_id", F.lit("Sequence Issue").alias("check_name"), F.col("severity").alias("status"),
                        "message")
    checks = dir_check.unionByName(seq_check).unionByName(each)
    rank = F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "WARN", 1).otherwise(0)
    overall = (parsed.select("target_id").distinct()
               .join(checks.groupBy("target_id").agg(F.max(rank).alias("r")), "target_id", "left")
               .select("target_id", F.when(F.col("r") == 2, "FAIL").when(F.col("r") == 1, "WARN")
                       .otherwise("PASS").alias("overall")))
    return checks, overall


# --- fixed values: directory check texts (R6 on a corpus on disk) ------------
MSG_DIR_MISSING = "Directory '%s' does not exist"
MSG_DIR_FILE = "'%s' exists but is not a directory"
MSG_DIR_UNREADABLE = "Cannot read directory '%s': %s"
MSG_DIR_FILES = "Found %d SQL migration files in '%s'"
# -------------------------------------------------------------------------------


def directory_health(spark, root: str) -> DataFrame:
    """R6 'Migrations Directory' on a corpus on disk: WARN when the folder is
    missing, FAIL when it is a file or cannot be read, else PASS with the
    number of ``.sql`` files per target folder (counted by Spark)."""
    from ..sources.corpus import folder_state, read_corpus

    def single(status: str, message: str) -> DataFrame:
        return spark.createDataFrame([("", "Migrations Directory", status, message)],
                                     "target_id string, check_name string, status string, message string")

    state, why = folder_state(spark, root)
    if state == "missing":
        return single("WARN", MSG_DIR_MISSING % root)
    if state == "file":
        return single("FAIL", MSG_DIR_FILE % root)
    if state == "unreadable":
        return single("FAIL", MSG_DIR_UNREADABLE % (root, why))
    files = read_corpus(spark, root).groupBy("target_id").agg(F.count(F.lit(1)).alias("n"))
    return files.select("target_id", F.lit("Migrations Directory").alias("check_name"), F.lit("PASS").alias("status"),
                        F.format_string(MSG_DIR_FILES, F.col("n"),
                                        F.concat(F.lit(root.rstrip("/") + "/"), F.col("target_id"))).alias("message"))
