"""Ledger event fold (L1-L7, W6, W8) and row changes (M*, R7-R9)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerfleet.operators import changes as cg
from ledgerfleet.operators import ledger_log as ll

LOG = "target_id string, version long, event_id long, ts timestamp_ntz, op string, ms int"


def ts(m):
    return dt.datetime(2024, 1, 1, 0, m)


def test_fold_semantics(spark):
    log = spark.createDataFrame([
        ("a", 1, 1, ts(1), "start", 0), ("a", 1, 2, ts(2), "success", 40), ("a", 1, 3, ts(3), "failure", 7),
        ("a", 2, 4, ts(1), "start", 0), ("a", 2, 5, ts(2), "remove", 0),
        ("a", 3, 6, ts(1), "success", 9),                                   # update without a row: no row
        ("a", 4, 7, ts(1), "start", 0), ("a", 4, 8, ts(2), "remove", 0), ("a", 4, 9, ts(3), "start", 0),
        ("a", 5, 11, ts(5), "failure", 3), ("a", 5, 10, ts(5), "start", 0),  # same ts: event id orders
        ("a", 6, 12, ts(1), "start", 0), ("a", 6, 13, ts(2), "failure", 4),
    ], LOG)
    st = {r.version: r for r in ll.ledger_state(log, ["target_id", "version"]).collect()}
    assert set(st) == {1, 4, 5, 6}
    assert (st[1].success, st[1].execution_time_ms, st[1].applied_at, st[1].last_op) == (False, 7, ts(2), "failure")
    assert (st[4].success, st[4].applied_at, st[4].last_op) == (False, ts(3), "start")
    assert (st[5].last_op, st[5].execution_time_ms) == ("failure", 3)
    assert st[6].applied_at == ts(1)                                        # failure keeps the start time
    fail = {r.event_id: r.applied_at for r in ll.record_failure(log, ["target_id", "version"]).collect()}
    assert fail[3] == ts(2) and fail[13] == ts(1) and fail[11] == ts(5)
    # a success without a live row updates nothing
    assert sorted(r.version for r in ll.record_success(log, ["target_id", "version"]).collect()) == [1]
    removed = sorted(r.version for r in ll.removed_keys(log, ["target_id", "version"]).collect())
    assert removed == [2]
    latest = {r.version: r.op for r in ll.latest_event(log, ["target_id", "version"]).collect()}
    assert latest[4] == "start" and latest[1] == "failure"


def test_remove_resets_the_row(spark):
    log = spark.createDataFrame([
        ("a", 1, 1, ts(1), "start", 0), ("a", 1, 2, ts(2), "remove", 0), ("a", 1, 3, ts(3), "failure", 5),
        ("a", 2, 4, ts(1), "start", 0), ("a", 2, 5, ts(2), "remove", 0), ("a", 2, 6, ts(3), "success", 5),
        ("a", 2, 7, ts(4), "failure", 6), ("a", 3, 8, ts(1), "start", 0), ("a", 3, 9, ts(2), "remove", 0),
        ("a", 3, 10, ts(3), "start", 0), ("a", 3, 11, ts(4), "failure", 6)], LOG)
    key = ["target_id", "version"]
    assert [(r.event_id, r.applied_at) for r in ll.record_failure(log, key).collect()] == [(11, ts(3))]
    assert ll.record_success(log, key).count() == 0
    assert [r.version for r in ll.ledger_state(log, key).collect()] == [3]


def test_folds_aggregate_in_a_hash_table(spark):
    d = "/root/testdata/sf0.001"
    from ledgerfleet.sources import bindings as b
    log = b.ledger_log(spark, d)
    for df in (ll.ledger_state(log, ["target_id", "version"]), ll.removed_keys(log, ["target_id", "version"]),
               ll.latest_event(log, ["target_id", "version"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_order_holds_for_far_times_and_large_sequences(spark):
    far = [dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1), dt.datetime(9999, 12, 31)]
    rows = [(k, t, s) for k, (t, s) in enumerate((t, s) for t in far for s in (0, 1, 2 ** 63 - 1))]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, event_id long")
    got = df.select("k", ll.event_order("ts", "event_id").alias("o")).orderBy("o").collect()
    assert [r.k for r in got] == list(range(len(rows))) and None not in [r.o for r in got]


def test_blocked_after_failure(spark):
    log = spark.createDataFrame([
        ("a", 1, 1, ts(1), "start", 0), ("a", 1, 2, ts(2), "failure", 0), ("a", 2, 3, ts(3), "start", 0),
        ("b", 1, 4, ts(1), "start", 0)], LOG)
    got = {r.event_id: r.blocked for r in ll.blocked_after_failure(log, ["target_id"]).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


def test_bump_counts(spark):
    hist = spark.createDataFrame([("a", 1, 2), ("a", 2, 5)], "target_id string, version long, execution_count long")
    run = spark.createDataFrame([("a", 2), ("a", 3), ("a", 3)], "target_id string, version long")
    got = {r.version: (r.execution_count, r.updated) for r in ll.bump_counts(hist, run, ["target_id", "version"]).collect()}
    assert got == {1: (2, False), 2: (6, True), 3: (1, True)}


ORD = "target_id long, o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, " \
      "o_orderpriority string"
CH = "target_id long, version long, o_orderkey long, op string, value double"


def test_apply_changes_stop_at_first_failure(spark):
    base = spark.createDataFrame([(0, 1, 10, "F", 5.0, ts(0), "1-URGENT"), (0, 2, 20, "F", 6.0, ts(0), "2-HIGH"),
                                  (1, 1, 30, "F", 7.0, ts(0), "1-URGENT")], ORD)
    ch = spark.createDataFrame([
        (0, 1, 1, "update", 50.0),      # applied: key 1 price 50
        (0, 2, 3, "update", 9.0),       # key 3 missing: no-op, not a failure
        (0, 3, 2, "delete", None),      # applied: key 2 gone
        (0, 4, 2, "insert", 60.0),      # applied: key 2 back (fresh row, defaults)
        (0, 5, 1, "insert", 1.0),       # fails: key 1 exists
        (0, 6, 4, "insert", 7.0),       # blocked
        (1, 7, 5, "insert", 8.0),       # other target: applied
        (1, 8, 2, "insert", 9.0),       # key 2 is the first target's: applied here
        (2, 9, 9, "insert", 1.0),       # a target with sequence issues: blocked
    ], CH)
    gate = spark.createDataFrame([(2,), (7,)], "target_id long")
    table, st = cg.apply_changes(base, ch, "o_orderkey", "o_totalprice", {"o_orderstatus": "O"}, gate)
    status = {r.version: r.status for r in st.collect()}
    assert status == {1: "applied", 2: "applied", 3: "applied", 4: "applied", 5: "failed", 6: "blocked",
                      7: "applied", 8: "applied", 9: "blocked"}
    rows = {(r.target_id, r.o_orderkey): r for r in table.collect()}
    assert set(rows) == {(0, 1), (0, 2), (1, 1), (1, 2), (1, 5)}
    assert rows[0, 1].o_totalprice == 50.0 and rows[0, 1].o_orderstatus == "F" and rows[1, 1].o_totalprice == 7.0
    assert rows[0, 2].o_totalprice == 60.0 and rows[0, 2].o_orderstatus == "O" and rows[0, 2].o_custkey is None
    ev = sorted((r.version, r.op) for r in cg.ledger_events(st).collect())
    assert (5, "failure") in ev and (6, "start") not in ev and (4, "success") in ev
    # target 0 can be rolled back; target 1 has a script without Down and one missing: it keeps everything
    scripts = spark.createDataFrame([(0, v, "versioned", f"{v}.sql", True) for v in (3, 4)] + [(1, 7, "versioned", "7.sql", False)],
                                    "target_id long, version long, kind string, path string, has_rollback boolean")
    check = {r.version: r.check_status for r in cg.rollback_check(st, scripts, 2).collect()}
    assert check == {3: "OK", 4: "OK", 7: "NO_DOWN", 8: "MISSING_FILE"}
    asof, removed = cg.rollback_changes(base, st, scripts, "o_orderkey", "o_totalprice", 2, {"o_orderstatus": "O"})
    assert {(r.target_id, r.o_orderkey): r.o_totalprice for r in asof.collect()} == {
        (0, 1): 50.0, (0, 2): 6.0, (1, 1): 7.0, (1, 5): 8.0, (1, 2): 9.0}
    assert sorted(r.version for r in removed.collect()) == [3, 4]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_version_is_a_filter_on_the_intervals(spark, seed):
    import random
    from ledgerfleet.operators.scan import freeze
    rnd = random.Random(seed)
    base = spark.createDataFrame([(t, k, 10, "F", float(k), ts(0), "x") for t in range(3) for k in range(0, 12, 2)], ORD)
    # one key takes a third of all changes
    ch = spark.createDataFrame([(rnd.randrange(3), v, 5 if v % 3 == 0 else rnd.randrange(12), rnd.choice(["insert", "update", "delete", "update"]),
                                 rnd.choice([None, 1.5, 2.5]) if v % 29 == 0 else float(v)) for v in range(1, 200)], CH)
    st = freeze(cg.change_status(ch, base, "o_orderkey"))
    applied = st.where("status = 'applied'")
    intervals = freeze(cg.validity(applied, "o_orderkey"))
    assert applied.count() > 20
    for v in (0, 7, 60, 10_000, None):
        replay = applied if v is None else applied.where(F.col("version") <= v)
        want = cg.apply_to_table(base, cg.fold_state(replay, "o_orderkey"), "o_orderkey", "o_totalprice", {"o_orderstatus": "O"})
        state = cg.as_of(intervals, v)
        got = cg.apply_to_table(base, state.select("target_id", "o_orderkey", "last_reset", "last_value"), "o_orderkey",
                                "o_totalprice", {"o_orderstatus": "O"})
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_update_to_null(spark):
    base = spark.createDataFrame([(0, 1, 10, "F", 5.0, ts(0), "x"), (0, 2, 10, "F", 6.0, ts(0), "x")], ORD)
    ups = spark.createDataFrame([(0, 1, 1, "update", 4.0), (0, 2, 1, "update", None)], CH)
    got = cg.update_where(base, ups, ["target_id", "o_orderkey"], "o_totalprice")
    assert {r.o_orderkey: r.o_totalprice for r in got.collect()} == {1: None, 2: 6.0}


def test_checks(spark):
    li = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "k long, n int")
    assert [tuple(r)[:2] for r in cg.check_unique(li, ["k", "n"]).collect()] == [(1, 1)]
    nn = {r.column_name: r.nulls for r in cg.check_not_null(spark.createDataFrame([(1, None), (None, None)],
                                                                                   "a int, b string"), "t").collect()}
    assert nn == {"a": 1, "b": 2}
    child = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id long, p long")
    parent = spark.createDataFrame([(10,)], "pk long")
    assert sorted(r.id for r in cg.check_foreign_key(child, parent, "p", "pk").collect()) == [2, 3]
    assert sorted(r.id for r in cg.cascade_delete(child, parent, "p", "pk").collect()) == [2, 3]
    cnt = {r.pk: r.n for r in cg.child_counts(spark.createDataFrame([(10,), (30,)], "pk long"), child, "pk", "p",
                                                 "n").collect()}
    assert cnt == {10: 1, 30: 0}
    kept = cg.delete_where(spark.createDataFrame([(1, None), (2, "F")], "k int, s string"),
                           F.col("s") == "F").collect()
    assert [r.k for r in kept] == [1]                        # NULL predicate keeps the row


def orders_table(spark, scratch, n=400, buckets=100):
    from ledgerfleet.operators.snapshots import SnapshotTable
    rows = [(k % 4, k, 10, "F", float(k), ts(0), "1-URGENT") for k in range(n)]
    return SnapshotTable.create(spark.createDataFrame(rows, ORD), f"{scratch}/orders", ["target_id", "o_orderkey"], buckets)


CHANGES = [(0, 1, 8, "update", 7.0), (0, 2, 9001, "insert", 3.0), (1, 3, 5, "delete", None), (2, 4, 6, "insert", 1.0),
           (2, 5, 10, "update", 5.0)]


def published(spark, root):
    from ledgerfleet.operators.snapshots import SnapshotTable
    t = SnapshotTable(spark, root)
    return sorted(map(str, t.read().collect())), sorted((r.target_id, r.version, r.op, r.snapshot) for r in t.events().collect())


def test_a_run_touches_only_its_buckets(spark, scratch):
    t = orders_table(spark, scratch)
    before = {str(r) for r in t.read().collect()}
    size = lambda df: sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())
    ups = spark.createDataFrame([(0, 1, 8, "update", 7.0)], CH)
    touched = t.touched(ups)
    assert len(touched) == 1
    part = t.read(0, touched)
    assert len(part.inputFiles()) == 1 and size(part) < size(t.read()) / 50      # 1 % of the buckets
    assert cg.publish_updates(t, ups, "o_totalprice", "r1") == 1
    new = [f for f in t.read().inputFiles() if "run=r1" in f]
    assert len(new) == 1 and len(t.read().inputFiles()) == len(t.read(0).inputFiles())
    after = {str(r) for r in t.read().collect()}
    assert len(after - before) == 1 and "o_totalprice=7.0" in (after - before).pop()
    assert {str(r) for r in t.read(0).collect()} == before                       # the old snapshot stays readable


def test_a_run_that_dies_after_any_step_is_repeated(spark, scratch, monkeypatch):
    from ledgerfleet.operators import snapshots
    ch = spark.createDataFrame(CHANGES, CH)
    base = spark.createDataFrame([(k % 4, k, 10, "F", float(k), ts(0), "1-URGENT") for k in range(40)], ORD)
    table, st = cg.apply_changes(base, ch, "o_orderkey", "o_totalprice", {"o_orderstatus": "O"})
    rows = sorted(map(str, table.collect()))
    events = sorted((r.target_id, r.version, r.op, 1) for r in cg.ledger_events(st).collect())
    assert len(events) == 8                                                      # four tried, one blocked
    real, steps = snapshots.write_step, 6
    # every step once, and the data and the events with files but without their mark
    for dies_at, partial in [(k, False) for k in range(steps)] + [(2, True), (4, True)]:
        root = f"{scratch}/{dies_at}{partial}"
        t = orders_table(spark, root, 40, 7)
        old = sorted(map(str, t.read().collect()))
        done = []

        def dying(df, path, *partitions):
            if len(done) == dies_at:
                if partial:
                    real(df, path, *partitions)
                    os.remove(f"{path}/_SUCCESS")
                raise OSError("lost")
            done.append(path)
            real(df, path, *partitions)

        def publish():
            return cg.publish_changes(t, ch, "o_orderkey", "o_totalprice", "r1", {"o_orderstatus": "O"}, at="2024-02-01 00:00:00")

        monkeypatch.setattr(snapshots, "write_step", dying)
        with pytest.raises(OSError):
            publish()
        assert sorted(map(str, t.read().collect())) == old                       # readers see nothing of it
        monkeypatch.setattr(snapshots, "write_step", real)
        assert publish() == 1 and publish() == 1                                 # repeated, and once too often
        assert published(spark, f"{root}/orders") == (rows, events)


def test_a_run_from_a_replaced_snapshot_is_refused(spark, scratch):
    t = orders_table(spark, scratch, 20, 3)
    ups = spark.createDataFrame([(0, 1, 8, "update", 7.0)], CH)
    t._step(f"{t.root}/starts/late", lambda: spark.createDataFrame([(0,)], "parent int"))
    cg.publish_updates(t, ups, "o_totalprice", "r1")
    with pytest.raises(RuntimeError, match="replaced"):
        cg.publish_updates(t, ups, "o_totalprice", "late")


def test_all_rows_of_a_bucket_may_go(spark, scratch):
    t = orders_table(spark, scratch, 8, 2)
    ch = spark.createDataFrame([(k % 4, k + 1, k, "delete", None) for k in range(8)], CH)
    assert cg.publish_changes(t, ch, "o_orderkey", "o_totalprice", "r1") == 1
    assert t.read().count() == 0 and t.events().count() == 16
    more = spark.createDataFrame([(0, 9, 77, "insert", 1.0)], CH)
    assert cg.publish_changes(t, more, "o_orderkey", "o_totalprice", "r2") == 2
    assert [r.o_orderkey for r in t.read().collect()] == [77]
