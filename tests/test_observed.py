"""Counters that come with a report from one pass (R2, R3 with A1, A2, A8)."""

import os

from pyspark.sql import functions as F

from ledgerfleet.operators import checks as ck
from ledgerfleet.operators import corpus as cp
from ledgerfleet.operators import reconcile as rc
from ledgerfleet.plans import inputs
from ledgerfleet.plans import reports as rp
from ledgerfleet.sources import bindings as b

SF = "/root/testdata/sf0.001"


def jobs(spark, name, act):
    spark.sparkContext.setJobGroup(name, name)
    try:
        act()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_report_and_counters_come_from_one_job(spark, scratch):
    keys, ledger = inputs.parsed(spark, SF), inputs.ledger(spark, SF)
    keys = cp.valid_scripts(keys)
    plain = rp.status_report(keys, ledger)
    report, seen = rp.observed_status(plain)
    out = os.path.join(scratch, "report")
    alone = jobs(spark, "plain", lambda: plain.write.parquet(out + "0"))
    both = jobs(spark, "observed", lambda: report.write.parquet(out))
    assert both == alone                                      # the counters cost no job
    per_target = rc.status_counts(keys, ledger)
    names = ["total", "applied", "failed", "pending", "skipped", "checksum_mismatches"]
    want = per_target.agg(*[F.sum(n).alias(n) for n in names]).first().asDict()
    kinds = keys.groupBy().agg(F.count_if(F.col("kind") == "versioned").alias("versioned"),
                               F.count_if(F.col("kind") == "repeatable").alias("repeatable")).first().asDict()
    assert seen.get == want | kinds and seen.get["total"] > 100 and seen.get["failed"] > 0
    assert spark.read.parquet(out).exceptAll(spark.read.parquet(out + "0")).count() == 0


def test_findings_and_counters(spark, scratch):
    keys, ledger = cp.valid_scripts(inputs.parsed(spark, SF)), inputs.ledger(spark, SF)
    findings, summary = rp.validate_report(keys, ledger, b.targets(spark, SF))
    counted, seen = rp.observed_findings(findings)
    counted.write.parquet(os.path.join(scratch, "findings"))
    names = ["errors", "checksum_mismatches", "orphans", "warnings"]
    want = summary.agg(*[F.sum(n).alias(n) for n in names]).first().asDict()
    assert seen.get == want | {"findings": findings.count()} and want["errors"] > 0


def test_counters_of_an_empty_report(spark):
    empty = spark.createDataFrame([], "target_id string, check string, severity string, subject string, message string")
    counted, seen = rp.observed_findings(empty)
    assert counted.collect() == [] and set(seen.get.values()) == {0}
