"""Scripts against the ledger, sequence checks, rollback and baseline on
hand-made rows (SURVEY section 5 cases)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerfleet.model import LEDGER_SCHEMA
from ledgerfleet.operators import checks as ck
from ledgerfleet.operators import corpus as cp
from ledgerfleet.operators import reconcile as rc
from ledgerfleet.operators import rollback as rb

T0 = dt.datetime(2024, 1, 1)


def corpus(spark, rows):
    df = spark.createDataFrame(rows, "target_id string, path string, body string")
    return cp.script_keys(cp.parse_scripts(df))


def ledger_rows(spark, rows):
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def md5(spark, text):
    return spark.createDataFrame([(text,)], "x string").select(F.md5("x")).first()[0]


def test_sequence_gap_duplicate_valid(spark):
    seq = spark.createDataFrame([("gap", 1), ("gap", 3), ("dup", 2), ("dup", 2), ("ok", 1), ("ok", 2), ("ok", 3)],
                                "target_id string, version long")
    pos = {(r.target_id, r.position): r.is_gap for r in ck.version_positions(seq).collect()}
    assert pos[("gap", 2)] is True and pos[("ok", 3)] is False
    assert not any(v for (t, _), v in pos.items() if t == "ok")
    dups = ck.later_duplicates(seq, "version").where("is_later_duplicate").collect()
    assert [(r.target_id, r.version) for r in dups] == [("dup", 2)]


def test_sequence_findings_with_repeatables(spark):
    k = corpus(spark, [("t", "0001_a.sql", "x"), ("t", "R__v.sql", "y"), ("t", "0003_c.sql", "z"),
                       ("t", "0003_d.sql", "w")])
    f = ck.sequence_findings(k).collect()
    checks = sorted((r.check, r.message) for r in f)
    assert ("duplicate_version", "Duplicate version 3 found in 0003_d.sql") in checks
    assert ("version_gap", "Version gap detected: expected 2, found Some(3) in 0003_c.sql") in checks
    assert all(r.severity == "WARN" for r in f)


def test_status_pending_drift_failed_orphan(spark):
    k = corpus(spark, [("t", "0001_a.sql", "A"), ("t", "0002_b.sql", "B"), ("t", "0003_c.sql", "C"),
                       ("t", "0004_d.sql", "D"), ("t", "R__v.sql", "V")])
    led = ledger_rows(spark, [
        ("t", "1", "versioned", 1, "0001_a.sql", md5(spark, "A"), T0, 5, True),
        ("t", "2", "versioned", 2, "0002_b.sql", "stale", T0, 5, True),
        ("t", "3", "versioned", 3, "0003_c.sql", md5(spark, "C"), T0, 5, False),
        ("t", "9", "versioned", 9, "0009_z.sql", "x", T0, 5, True),
        ("t", "4", "baseline", 4, "baseline_0004_x", "baseline", T0, 0, True),   # same id as script 4 (Q11)
    ])
    st = {r.migration_id: r.state for r in rc.reconcile(k, led).collect()}
    assert st == {"1": "APPLIED", "2": "DRIFT", "3": "FAILED", "9": "ORPHAN", "4": "PENDING", "R__v": "PENDING"}
    counts = rc.status_counts(k, led).first()
    assert (counts.total, counts.applied, counts.failed, counts.skipped, counts.baseline_version) == (5, 2, 1, 4, 4)
    assert counts.pending == 1   # the repeatable; 1-4 are at or below the baseline


def test_pending_sets(spark):
    k = corpus(spark, [("t", "0001_a.sql", "A"), ("t", "0002_b.sql", "B"), ("t", "R__v.sql", "V"),
                       ("t", "R__w.sql", "W")])
    led = ledger_rows(spark, [
        ("t", "1", "versioned", 1, "0001_a.sql", md5(spark, "A"), T0, 5, True),
        ("t", "R__v", "repeatable", None, "R__v.sql", "old", T0, 5, True),
        ("t", "R__w", "repeatable", None, "R__w.sql", md5(spark, "W"), T0, 5, True),
    ])
    assert sorted(r.path for r in rc.pending(k, led).collect()) == ["0002_b.sql", "R__v.sql"]


def test_rollback_plans(spark):
    k = corpus(spark, [("t", "0001_a.sql", "-- UP\nA\n-- DOWN\nDROP a"), ("t", "0002_b.sql", "-- UP\nB\n-- DOWN\n"),
                       ("t", "0003_c.sql", "-- UP\nC\n-- DOWN\nDROP c")])
    led = ledger_rows(spark, [
        ("t", "1", "versioned", 1, "0001_a.sql", "x", T0, 100, True),
        ("t", "2", "versioned", 2, "0002_b.sql", "x", T0, 100, False),   # failed: skipped
        ("t", "3", "versioned", 3, "0003_c.sql", "x", T0, 100, True),
        ("t", "5", "versioned", 5, "0005_e.sql", "x", T0, 100, True),    # no file
        ("t", "R__v", "repeatable", None, "R__v.sql", "x", T0, 100, True),
        ("t", "9", "baseline", 9, "baseline_0009", "baseline", T0, 0, True),
    ])
    steps = rb.plan_steps(led, 10).orderBy("rollback_order").collect()
    assert [r.version for r in steps] == [5, 3, 1] and steps[0].rollback_total == 3   # fewer than asked
    checked = rb.check_plan(rb.plan_steps(led, 10), k)
    summary = rb.plan_summary(checked, led, "steps").first()
    assert summary.status == "MISSING_FILE" and "version 5" in summary.message
    tv = rb.plan_to_version(led, 1).orderBy("rollback_order").collect()
    assert [r.version for r in tv] == [5, 3]                        # strictly above 1 (Q20)
    empty = rb.plan_summary(rb.check_plan(rb.plan_to_version(led, 50), k), led, "to_version", 50).first()
    assert empty.status == "INVALID_TARGET"
    ok = rb.plan_summary(rb.check_plan(rb.plan_to_version(led.where("version <> 5"), 1), k), led, "to_version", 1)
    assert ok.first().status == "OK"


def test_no_down_text(spark):
    k = corpus(spark, [("t", "0001_a.sql", "-- UP\nA\n-- DOWN\n   ")])
    led = ledger_rows(spark, [("t", "1", "versioned", 1, "0001_a.sql", "x", T0, 100, True)])
    r = rb.check_plan(rb.plan_steps(led, 1), k).first()
    assert r.check_status == "NO_DOWN" and r.message.endswith("no rollback SQL found")


def test_baseline_plan(spark):
    led = ledger_rows(spark, [
        ("a", "3", "versioned", 3, "0003.sql", "x", T0, 1, True),
        ("b", "7", "versioned", 7, "0007.sql", "x", T0, 1, True),
        ("c", "5", "baseline", 5, "baseline_0005", "baseline", T0, 0, True),
    ])
    props = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "target_id string, new_baseline long")
    plan = {r.target_id: r.status for r in rb.baseline_plan(led, props, "Init Schema", "2024-06-01 00:00:00").collect()}
    assert plan == {"a": "CREATE", "b": "CONFLICT", "c": "EXISTS"}
    rows = rb.baseline_rows(rb.baseline_plan(led, props, "Init Schema", "2024-06-01 00:00:00")).collect()
    assert [(r.target_id, r.filename) for r in rows] == [("a", "baseline_0005_init_schema")]


def test_retries_fold_to_the_latest_row(spark):
    k = corpus(spark, [("t", "0001_a.sql", "A;"), ("t", "0002_b.sql", "B;")])
    a = md5(spark, "A;")
    led = ledger_rows(spark, [
        ("t", "1", "versioned", 1, "0001_a.sql", "old", T0, 1, False),
        ("t", "1", "versioned", 1, "0001_a.sql", a, T0 + dt.timedelta(hours=1), 2, True),
        ("t", "2", "versioned", 2, "0002_b.sql", md5(spark, "B;"), T0, 3, True),
        ("t", "2", "versioned", 2, "0002_b.sql", "x", T0 + dt.timedelta(hours=1), 4, False)])
    st = {r.migration_id: (r.status, r.checksum_mismatch) for r in rc.status_join(k, led).collect()}
    assert st == {"1": ("APPLIED", False), "2": ("FAILED", True)}
    assert rc.status_counts(k, led).first()["total"] == 2 and rc.reconcile(k, led).count() == 2
    assert sorted(r.check for r in ck.ledger_findings(k, led).collect()) == ["checksum_mismatch", "failed"]


def test_clean_targets_pass(spark):
    targets = spark.createDataFrame([("a",), ("b",)], "target_id string")
    f = spark.createDataFrame([("a", "orphan", "FAIL", "x", "m")], "target_id string, check string, severity string, subject string, message string")
    assert {r.target_id: r.status for r in ck.worst_status(f, targets).collect()} == {"a": "FAIL", "b": "PASS"}
    assert {r.target_id: r.verdict for r in ck.validation_summary(f, targets).collect()} == {"a": "FAILED", "b": "PASSED"}


def test_sequence_issues_stop_an_apply_only(spark):
    k = corpus(spark, [("gap", "0002_a.sql", "A;"), ("ok", "0001_a.sql", "A;")])
    assert {r.severity for r in ck.sequence_findings(k).collect()} == {"WARN"}
    assert {r.severity for r in ck.sequence_findings(k, "apply").collect()} == {"FAIL"}
    assert [r.target_id for r in ck.apply_gate(k).collect()] == ["gap"]


def test_reports_without_a_ledger(spark):
    from ledgerfleet.plans import reports as rp
    k = corpus(spark, [("t", "0002_a.sql", "A;\nB;"), ("t", "R__v.sql", "V;")])
    assert {r.status for r in rp.status_report(k, None).collect()} == {"PENDING"}
    findings, summary = rp.validate_report(k, None)
    assert summary.first()["warnings"] == 1 and summary.first()["verdict"] == "PASSED"
    assert tuple(rp.validate_files(k).first()) == ("t", 2, 1, 1, 3)


def test_positions_come_from_bitmaps(spark, monkeypatch):
    import random

    from pyspark.sql import Window
    rnd = random.Random(4)
    rows = [("hot", v, f"{v}_{k}.sql") for v in rnd.sample(range(0, 200_000), 900) for k in range(1 if v % 7 else 3)]
    rows += [("hot", 4_294_967_295, "max.sql"), ("hot", 32_768, "a"), ("hot", 32_767, "b"), ("hot", 32_769, "c")]
    rows += [(f"t{k % 9}", v, f"{k}.sql") for k, v in enumerate(rnd.choices(range(1, 60), k=300))]
    rows += [("many", 5, f"{k:04d}.sql") for k in range(200)] + [("many", 4, "x"), ("many", 6, "y"), ("same", 1, "z"), ("same", 1, "z")]
    df = spark.createDataFrame(rows, "target_id string, version long, path string").repartition(6)
    want = df.withColumn("position", F.row_number().over(Window.partitionBy("target_id").orderBy("version", "path")).cast("long"))
    want = sorted(map(tuple, want.select("target_id", "version", "path", "position").collect()))
    for heavy in (1_000_000, 100):
        monkeypatch.setattr(ck, "HEAVY_VERSION", heavy)
        got = ck.version_positions(df, ["path"])
        assert sorted(map(tuple, got.select("target_id", "version", "path", "position").collect())) == want
        if heavy > 100:              # no range sort of the rows, no checkpoint of them
            assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert ck.version_positions(df.limit(0), ["path"]).count() == 0
