"""The reconciled table that signed rows keep up to date."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerfleet.model import LEDGER_SCHEMA
from ledgerfleet.operators import incremental as inc
from ledgerfleet.operators import reconcile as rc

CORPUS = "target_id string, identifier string, kind string, version long, filename string, checksum string"
T0 = dt.datetime(2024, 1, 1)


def script(t, k, checksum="c"):
    return (t, f"V{k}", "versioned", k, f"{k:04d}_x.sql", checksum)


def ran(t, k, at, ok=True, checksum="c", kind="versioned"):
    return (t, f"V{k}", kind, k, f"{k:04d}_x.sql", checksum, None if at is None else T0 + dt.timedelta(hours=at), 5, ok)


def frames(spark, scripts, ledger):
    return spark.createDataFrame(scripts, CORPUS), spark.createDataFrame(ledger, LEDGER_SCHEMA)


def signed(spark, old, new):
    return inc.signed_difference(spark.createDataFrame(old, CORPUS), spark.createDataFrame(new, CORPUS)).withColumnRenamed(
        "identifier", "migration_id")


def lines(df):
    return sorted(map(str, df.collect()))


def same_as_full(spark, table, scripts, ledger):
    full = rc.reconcile(*frames(spark, scripts, ledger))
    assert lines(inc.reconciled(table)) == lines(full)
    counts = full.groupBy("target_id", "state").agg(F.count(F.lit(1)).alias("n"))
    assert lines(inc.state_counts(table)) == lines(counts.select("target_id", "state", "n"))


def test_runs_equal_the_full_join(spark, scratch):
    rng = random.Random(4)
    scripts = [script(t, k) for t in "aab" for k in range(12)]            # every script of a stands twice
    ledger = [ran(t, k, k) for t in "ab" for k in range(0, 9)] + [ran("a", 3, 1, False), ran("b", 90, None, False),
                                                                   ran("a", 0, 0, kind="baseline")]
    table = inc.create(spark, f"{scratch}/r", 8)
    inc.publish(table, "load", signed(spark, [], scripts), frames(spark, scripts, ledger)[1])
    same_as_full(spark, table, scripts, ledger)
    for n in range(2):
        edited = list(scripts)
        for _ in range(5):
            edited.pop(rng.randrange(len(edited)))
        edited += [script("a", 20 + n), script("b", 1, f"edit{n}"), script("c", 1)]
        # a late row (loses), a tie (the success wins), a retry, a first run, an orphan
        new = [ran("a", 5, 0, False), ran("a", 6, 6, False), ran("b", 8, 30 + n, n == 0), ran("c", 1, 3), ran("c", 70 + n, 1)]
        gone = [("a", f"V{7 + n}"), ("b", "V90")]
        ledger = [r for r in ledger if (r[0], r[1]) not in gone] + new
        inc.publish(table, f"run{n}", signed(spark, scripts, edited), frames(spark, scripts, new)[1],
                    spark.createDataFrame(gone, "target_id string, migration_id string"))
        scripts = edited
        same_as_full(spark, table, scripts, ledger)


def test_a_run_reads_and_writes_the_buckets_of_its_keys(spark, scratch):
    scripts, ledger = [script("hot", k) for k in range(400)], [ran("hot", k, k) for k in range(300)]
    table = inc.create(spark, f"{scratch}/r", 100)
    inc.publish(table, "load", signed(spark, [], scripts), frames(spark, scripts, ledger)[1])
    read, asked = table.read, []
    table.read = lambda snapshot=None, buckets=None: asked.append(buckets) or read(snapshot, buckets)
    new = [ran("hot", k, 500) for k in (350, 351)]
    inc.publish(table, "r1", ledger=frames(spark, scripts, new)[1])
    assert asked and all(len(b) <= 2 for b in asked)
    table.read = read
    assert 1 <= sum("run=r1" in f for f in table.read().inputFiles()) <= 2
    same_as_full(spark, table, scripts, ledger + new)
    # rows that change nothing touch no bucket
    inc.publish(table, "r2", ledger=frames(spark, scripts, [ran("hot", 1, -5, False), ran("hot", 2, 2)])[1])
    assert not any("run=r2" in f for f in table.read().inputFiles())
    assert table.events().where("run = 'r2'").count() == 0
    same_as_full(spark, table, scripts, ledger + new)
    inc.publish(table, "r3")                                              # nothing new at all
    same_as_full(spark, table, scripts, ledger + new)


def test_a_run_that_dies_is_repeated_once(spark, scratch, monkeypatch):
    from ledgerfleet.operators import snapshots
    scripts, ledger, new = [script("a", k) for k in range(6)], [ran("a", 0, 0)], [ran("a", 1, 1), ran("a", 2, 2, False)]
    table = inc.create(spark, f"{scratch}/r", 4)
    inc.publish(table, "load", signed(spark, [], scripts), frames(spark, scripts, ledger)[1])
    real = snapshots.write_step
    for dies_at in ("status/", "data/", "snapshots/", "events/", "commits/"):
        def dying(df, path, *partitions, dies_at=dies_at):
            if dies_at in path:
                raise OSError("lost")
            real(df, path, *partitions)

        monkeypatch.setattr(snapshots, "write_step", dying)
        with pytest.raises(OSError):
            inc.publish(table, "r1", ledger=frames(spark, scripts, new)[1])
        same_as_full(spark, table, scripts, ledger)
    monkeypatch.setattr(snapshots, "write_step", real)
    for _ in range(2):
        assert inc.publish(table, "r1", ledger=frames(spark, scripts, new)[1]) == 2
        same_as_full(spark, table, scripts, ledger + new)


def test_an_empty_fleet(spark, scratch):
    table = inc.create(spark, f"{scratch}/r", 4)
    inc.publish(table, "load")
    assert inc.reconciled(table).count() == 0 and inc.state_counts(table).count() == 0
