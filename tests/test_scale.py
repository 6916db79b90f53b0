"""Scale properties: hot groups are split, partial aggregation happens before
the shuffle, top-N is limited map-side, scans are pruned."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerfleet.operators import rollback as rb
from ledgerfleet.operators.joins import per_target_join
from ledgerfleet.operators.scan import last_before, ordinal


def skewed(spark, n=20000):
    # one target holds 90% of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), (F.col("id") % 7).cast("string")))
         .otherwise(F.lit("hot")).alias("target_id"),
        (F.col("id") * 7919 % n).alias("version"), F.col("id").alias("seq"),
        F.when(F.col("id") % 13 == 0, F.col("id")).alias("val"))


def test_ordinal_matches_window_on_hot_group(spark):
    df = skewed(spark)
    got = ordinal(df, ["target_id"], [F.col("version"), F.col("seq")], "pos", slices=16)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("target_id").orderBy("version", "seq")))
    assert got.count() == df.count()
    assert got.select("target_id", "seq", "pos").exceptAll(want.select("target_id", "seq", "pos")).count() == 0


def test_hot_group_spans_many_slices(spark):
    df = skewed(spark)
    ranged = df.repartitionByRange(16, "target_id", "version", "seq").withColumn("s", F.spark_partition_id())
    spans = ranged.where(F.col("target_id") == "hot").select("s").distinct().count()
    assert spans >= 10          # the hot target is cut into many bounded slices


def test_last_before_matches_window(spark):
    df = skewed(spark, 5000)
    got = last_before(df, ["target_id"], [F.col("version"), F.col("seq")], "val", "prev", slices=8)
    w = Window.partitionBy("target_id").orderBy("version", "seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("prev", F.last("val", ignorenulls=True).over(w))
    assert got.select("seq", "prev").exceptAll(want.select("seq", "prev")).count() == 0


def test_ordinal_over_nulls_and_no_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5), ("a", 4)], "g string, v int")
    got = sorted((str(r.g), r.v, r.p) for r in ordinal(df, ["g"], ["v"], "p", at_most=4).collect())
    assert got == [("None", 1, 1), ("None", 2, 2), ("a", 4, 1), ("a", 5, 2)]
    assert sorted((r.v, r.p) for r in ordinal(df, [], ["v"], "p").collect()) == [(1, 1), (2, 2), (4, 3), (5, 4)]
    assert ordinal(df.limit(0), ["g"], ["v"], "p").count() == 0


def test_slices_follow_the_rows(spark, monkeypatch):
    from ledgerfleet.operators import scan
    monkeypatch.setattr(scan, "SLICE_ROWS", 500)
    df = skewed(spark, 9000)
    sliced = scan._sliced(df, ["target_id"], [F.col("version"), F.col("seq")], None)
    assert sliced.select("__slice").distinct().count() > 10
    got = ordinal(df, ["target_id"], [F.col("version"), F.col("seq")], "pos")
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("target_id").orderBy("version", "seq")))
    assert got.select("seq", "pos").exceptAll(want.select("seq", "pos")).count() == 0


def test_last_before_of_several_values(spark):
    df = skewed(spark, 3000).withColumn("other", F.when(F.col("seq") % 5 == 0, F.col("version")))
    got = last_before(df, ["target_id"], [F.col("version"), F.col("seq")], ["val", "other"], ["p", "q"], slices=8)
    w = Window.partitionBy("target_id").orderBy("version", "seq").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("seq", F.last("val", ignorenulls=True).over(w).alias("p"), F.last("other", ignorenulls=True).over(w).alias("q"))
    assert got.select("seq", "p", "q").exceptAll(want).count() == 0


NAME_QUERIES = ["rows_as_text", "scalar_lookup", "filter_rollbackable", "filter_failed", "filter_below_baseline", "filter_conflicting",
                "filter_above_target", "pending_versioned", "orphans", "baseline_skip", "is_applied_count",
                "applied_matches_corpus", "duplicate_names", "is_applied", "status_label", "rollback_steps", "take_until",
                "create_baseline", "baseline_report", "baseline_would_skip", "file_count", "classify_filename", "canonical_filename",
                "identifier", "filter_kind", "filter_invalid_names", "count_by_kind", "worst_status", "latest_version",
                "corpus_order", "ledger_order", "plan_order", "rollback_order", "health_report"]


def test_queries_of_the_name_layer_read_no_text(spark):
    """Neither the plan of the result nor any job before it (ordered scans
    freeze their input) reads the script text."""
    import __spark_entry__ as E
    queries = E.queries()
    frozen = []
    from ledgerfleet.operators import scan
    keep = scan.freeze
    scan.freeze = lambda df: frozen.append(df) or keep(df)
    try:
        for name in NAME_QUERIES:
            if name == "worst_status":          # drift needs the text
                continue
            frozen.clear()
            df = queries[name](spark, "/root/testdata/sf0.001")
            for own in [df, *frozen]:
                plan = own._jdf.queryExecution().executedPlan().toString()
                for scan_line in (x for x in plan.split("\n") if "FileScan" in x and "documents" in x):
                    assert "text:" not in scan_line, (name, scan_line)
    finally:
        scan.freeze = keep


def test_no_text_is_shuffled_by_corpus_queries(spark):
    import __spark_entry__ as E
    queries = E.queries()
    for name in ("split_up_down", "checksum", "preview", "split_statements", "file_count", "script_corpus_scan"):
        plan = queries[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert name == "file_count" or "Exchange" not in plan, (name, plan)


def test_salted_join_is_exact(spark):
    df = skewed(spark, 5000)
    small = df.groupBy("target_id").agg(F.max("version").alias("mx"))
    a = per_target_join(df, small, ["target_id"], "left", spread_by=["seq"])
    b = df.join(small, "target_id", "left")
    assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_is_limited_before_shuffle(spark):
    from ledgerfleet.model import LEDGER_SCHEMA
    import datetime as dt
    rows = [("t", str(i), "versioned", i, f"{i}.sql", "x", dt.datetime(2024, 1, 1), 1, True) for i in range(50)]
    plan = plan_of(rb.plan_steps(spark.createDataFrame(rows, LEDGER_SCHEMA), 3))
    assert "WindowGroupLimit" in plan


def test_partial_aggregation_and_pruning(spark):
    from ledgerfleet.operators import ledger_log as ll
    from ledgerfleet.sources import bindings as b
    d = "/root/testdata/sf0.001"
    plan = plan_of(ll.ledger_state(b.ledger_log(spark, d), ["target_id", "version"]))
    assert "partial_max" in plan and "SortAggregate" not in plan
    ex = ll.ledger_state(b.ledger_log(spark, d), ["target_id", "version"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "props" not in ex.split("ReadSchema")[-1].split("\n")[0]      # unused column never read


def test_bucketed_tables_join_without_shuffle(spark, scratch):
    import os
    from ledgerfleet.sources.tables import save_bucketed
    k = spark.range(2000).select((F.col("id") % 7).cast("string").alias("target_id"),
                                 F.col("id").cast("string").alias("migration_id"), F.lit("c").alias("checksum"))
    led = k.select("target_id", "migration_id", F.lit("s").alias("stored_checksum"))
    save_bucketed(k, "keys_b", os.path.join(scratch, "keys_b"), 8)
    save_bucketed(led, "ledger_b", os.path.join(scratch, "ledger_b"), 8)
    j = spark.table("keys_b").join(spark.table("ledger_b"), ["target_id", "migration_id"], "full_outer")
    assert j.count() == 2000
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
