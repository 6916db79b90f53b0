"""File corpus source (S1, S2), catalog helpers and the streams (ST1, ST2)."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerfleet.operators import catalog as ct
from ledgerfleet.operators import corpus as cp
from ledgerfleet.operators import ledger_log as ll
from ledgerfleet.sources.corpus import read_corpus
from ledgerfleet.streaming import streams as st


def write_tree(root, files):
    for rel, body in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(body)


def test_read_corpus(spark, scratch):
    write_tree(scratch, {"db1/0001_a.sql": "-- UP\nA;\n-- DOWN\nB;", "db1/notes.txt": "x", "db1/.sql": "y",
                         "db2/R__v.sql": "CREATE VIEW v;\n", "db2/0002_b.SQL": "upper ext"})
    df = read_corpus(spark, scratch)
    got = sorted((r.target_id, r.path) for r in df.collect())
    assert got == [("db1", "0001_a.sql"), ("db2", "R__v.sql")]
    body = [r.body for r in df.collect() if r.path == "R__v.sql"][0]
    assert body == "CREATE VIEW v;\n"                                       # whole text kept
    assert read_corpus(spark, os.path.join(scratch, "missing")).count() == 0   # S2


def test_read_corpus_decodes_names_and_keeps_folders_apart(spark, scratch):
    root = os.path.join(scratch, "my fleet+1")
    write_tree(root, {"a/db/0001_my table.sql": "A;", "b/db/0001_my table.sql": "B;", "c d/R__v+é%20.sql": "V;", "0002_top.sql": "T;"})
    for df in (read_corpus(spark, root), read_corpus(spark, "file://" + root + "/")):
        assert sorted((r.target_id, r.path, r.body) for r in df.collect()) == [
            ("", "0002_top.sql", "T;"), ("a/db", "0001_my table.sql", "A;"), ("b/db", "0001_my table.sql", "B;"),
            ("c d", "R__v+é%20.sql", "V;")]
    names = {r.identifier for r in cp.parse_scripts(read_corpus(spark, root)).collect()}
    assert names == {"1", "2", "R__v+é%20"}


def test_read_single_folder(spark, scratch):
    write_tree(scratch, {"0001_a.sql": "A;", "R__v.sql": "V;", "sub/0002_b.sql": "not read (not recursive)"})
    got = sorted((r.target_id, r.path) for r in read_corpus(spark, scratch, fleet=False).collect())
    assert got == [("default", "0001_a.sql"), ("default", "R__v.sql")]


def test_script_file_stream(spark, scratch):
    src = os.path.join(scratch, "src")
    write_tree(src, {"db1/0001_a.sql": "-- UP\nA;\n-- DOWN\nB;", "db1/0002_b.sql": "C;"})
    sink, ck = os.path.join(scratch, "sink"), os.path.join(scratch, "ck")
    st.run_to_completion(st.start_script_ingest_stream(st.script_file_stream(spark, src), sink, ck))
    first = spark.read.parquet(sink).count()
    write_tree(src, {"db2/R__v.sql": "V;"})                                  # a new file arrives
    st.run_to_completion(st.start_script_ingest_stream(st.script_file_stream(spark, src), sink, ck))
    got = spark.read.parquet(sink)
    batch = cp.script_keys(cp.parse_scripts(read_corpus(spark, src)))
    assert first == 2 and got.count() == 3
    assert got.select(*batch.columns).exceptAll(batch).count() == 0


@pytest.mark.parametrize("store", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_ledger_stream_state_over_restarts_and_late_events(spark, scratch, store):
    import datetime as dt
    key, ck = ["target_id", "version"], os.path.join(scratch, "ck")
    rows = [("a", 1, i, dt.datetime(2024, 1, 1, 0, i), op, i) for i, op in
            enumerate(["start", "success", "failure", "start", "remove", "start"])]
    # key 2: the success arrives in the second batch but happened first (late data)
    rows[3:3] = [("a", 2, 20, dt.datetime(2024, 1, 1, 0, 9), "start", 0)]
    rows += [("a", 2, 21, dt.datetime(2024, 1, 1, 0, 10), "success", 5),
             ("a", 2, 19, dt.datetime(2024, 1, 1, 0, 8), "failure", 9)]
    more = [("a", 3, 30, dt.datetime(2024, 1, 2), "start", 0), ("a", 2, 31, dt.datetime(2024, 1, 2), "failure", 8),
            ("a", 1, 3, dt.datetime(2024, 1, 1, 0, 3), "start", 3)]             # an event delivered twice
    schema = "target_id string, version long, event_id long, ts timestamp_ntz, op string, ms int"
    src, seen = os.path.join(scratch, "events"), []
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, f"org.apache.spark.sql.execution.streaming.state.{store}")
    try:
        for k, batch in enumerate([rows[:4], rows[4:], more]):                   # the stream stops and restarts each time
            seen += batch
            spark.createDataFrame(batch, schema).write.parquet(os.path.join(src, f"b{k}"))
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
            st.run_to_completion(st.start_ledger_state_stream(stream, key, ck, os.path.join(scratch, "feed")))
            got = st.read_ledger_state(spark, ck, key)
            want = ll.ledger_state(spark.createDataFrame(seen, schema), key)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Aggregate" not in plan and "Exchange" not in plan            # state rows as they are
        first = st.read_ledger_state(spark, ck, key, batch_id=0)
        want = ll.ledger_state(spark.createDataFrame(rows[:4], schema), key)
        assert sorted(map(tuple, first.collect())) == sorted(map(tuple, want.collect()))
        assert spark.read.parquet(os.path.join(scratch, "feed")).select("_batch_id").distinct().count() == 3
    finally:
        spark.conf.set(name, old)


CATALOG = "target_id string, dialect string, schema_name string, object_type string, object_name string, is_temporary boolean"


def test_live_catalog_tells_views_from_tables(spark, scratch):
    spark.range(3).createOrReplaceTempView("tmp_things")
    spark.sql(f"CREATE TABLE own_things (id INT) USING parquet LOCATION '{scratch}/own'")
    try:
        got = {r.object_name: (r.object_type, r.is_temporary) for r in ct.live_catalog(spark).collect()}
        assert got["tmp_things"] == ("view", True) and got["own_things"] == ("table", False)
        assert "default" in [r.schema_name for r in ct.live_schemas(spark).collect()]
        assert [r.object_name for r in ct.user_tables(ct.live_catalog(spark)).where("object_name like 'own%'").collect()] \
            == ["own_things"]
    finally:
        spark.sql("DROP TABLE own_things")
        spark.catalog.dropTempView("tmp_things")


def test_system_objects_go_by_schema(spark):
    rows = [("t", "PostgreSQL", "public", "table", "pg_archive", False), ("t", "PostgreSQL", "pg_catalog", "table", "pg_class", False),
            ("t", "MySQL", "sys", "table", "x", False), ("t", "MySQL", "app", "table", "sys.y", False),
            ("t", "SQLite", "main", "table", "sqlite_stat1", False), ("t", "PostgreSQL", "public", "table", "sqlite_x", False),
            ("t", "SQLite", None, "view", "sqlite_v", False), ("t", None, None, "table", "free", False)]
    got = {r.object_name for r in ct.inventory(spark.createDataFrame(rows, CATALOG)).collect()}
    assert got == {"pg_archive", "sys.y", "sqlite_x", "sqlite_v", "free"}


def test_snapshots_of_two_baselines_stay(spark, scratch):
    import pytest
    c = spark.createDataFrame([("t", "SQLite", "main", "table", n, False) for n in ("a", "schema_migrations")], CATALOG)
    out = []
    for v in (1, 2):
        lines = ct.snapshot_lines(c, spark.createDataFrame([("t", v)], "target_id string, baseline_version long"))
        out.append(ct.write_snapshot(lines, scratch, v))
    assert [spark.read.parquet(p).count() for p in out] == [5, 5]        # four fixed lines, one table
    with pytest.raises(Exception):
        ct.write_snapshot(lines, scratch, 2)


def test_snapshot_files_follow_tasks_not_targets(spark, scratch):
    rows = [(f"t{k:03d}", "SQLite", "main", "table", f"x{j}", False) for k in range(150) for j in range(2)]
    rows += [("t077", "SQLite", "main", "table", f"big{j:04d}", False) for j in range(3000)]
    versions = spark.createDataFrame([(f"t{k:03d}", 3) for k in range(150)], "target_id string, baseline_version long")
    lines = ct.snapshot_lines(spark.createDataFrame(rows, CATALOG), versions)
    out = ct.write_snapshot(lines, scratch, 3)
    files = [f for _, _, names in os.walk(out) for f in names if f.endswith(".parquet")]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = ct.read_snapshot(spark, scratch, 3, "t077")
    assert [r.line_no for r in big.orderBy("line_no").collect()] == list(range(1, 3007))
    assert "EqualTo(target_id,t077)" in big._jdf.queryExecution().executedPlan().toString()
    assert ct.read_snapshot(spark, scratch, 3).exceptAll(lines).count() == 0


def test_snapshot_lines(spark):
    c = spark.createDataFrame([("t", "SQLite", "main", "table", n, False) for n in ("b", "a", "sqlite_x")], CATALOG)
    v = spark.createDataFrame([("t", 7)], "target_id string, baseline_version long")
    lines = [r.line for r in ct.snapshot_lines(c, v).orderBy("line_no").collect()]
    assert lines == ["-- Schema dump for baseline version 7", "-- Tables found:", "-- Table: a", "-- Table: b",
                     "-- This is a baseline marker - no actual DDL to execute",
                     "-- Database was baselined at version 7"]


def test_directory_health(spark, scratch):
    from ledgerfleet.plans.reports import directory_health
    write_tree(scratch, {"db1/0001_a.sql": "A;", "db1/0002_b.sql": "B;", "db2/R__v.sql": "V;"})
    got = {r.target_id: (r.status, r.message) for r in directory_health(spark, scratch).collect()}
    assert got["db1"] == ("PASS", f"Found 2 SQL migration files in '{scratch}/db1'")
    missing = directory_health(spark, scratch + "/nope").first()
    assert missing.status == "WARN" and "does not exist" in missing.message
    write_tree(scratch, {"plain.txt": "x"})
    single = directory_health(spark, scratch + "/plain.txt").first()
    assert single.status == "FAIL" and single.message.endswith("exists but is not a directory")
    broken = directory_health(spark, "nostore://x/y").first()
    assert broken.status == "FAIL" and broken.message.startswith("Cannot read directory")


def test_table_stream_of_part_files(spark, scratch):
    """A table may be one file or a folder of part files, also partitioned by a column; parts that arrive later are read."""
    rows = spark.range(40).select("id", (F.col("id") * 3).alias("v"), F.when(F.col("id") % 4 == 0, "en").otherwise("de").alias("lang"))
    folder = os.path.join(scratch, "tables")
    rows.repartition(4).write.parquet(os.path.join(folder, "parts.parquet"))
    rows.write.partitionBy("lang").parquet(os.path.join(folder, "dealt.parquet"))
    rows.coalesce(1).write.parquet(os.path.join(scratch, "one"))
    [only] = [f for f in os.listdir(os.path.join(scratch, "one")) if f.endswith(".parquet")]
    os.rename(os.path.join(scratch, "one", only), os.path.join(folder, "single.parquet"))

    def read(name):
        sink, ck = os.path.join(scratch, "sink", name), os.path.join(scratch, "ck", name)
        w = st.table_stream(spark, folder, name).writeStream.format("parquet").option("path", sink)
        st.run_to_completion(w.option("checkpointLocation", ck).trigger(availableNow=True).start())
        return sorted((r.id, r.v, r.lang) for r in spark.read.parquet(sink).collect())

    want = sorted((r.id, r.v, r.lang) for r in rows.collect())
    assert [read(name) == want for name in ("single", "parts", "dealt")] == [True, True, True]
    more = spark.createDataFrame([(100, 1, "fr")], rows.schema)
    more.write.mode("append").parquet(os.path.join(folder, "parts.parquet"))
    assert read("parts") == want + [(100, 1, "fr")]


def test_stream_queries_over_tables_of_part_files(spark, scratch):
    import __spark_entry__ as E
    import datetime as dt
    docs = [(k, f"SELECT {k};\nSELECT 2;", ["en", "de"][k % 2], f"src{k % 3}") for k in range(60)] + [(60, None, None, "src1")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(5) \
        .write.parquet(os.path.join(scratch, "documents.parquet"))
    events = [(k, dt.datetime(2024, 1, 1, 0, k % 60), k % 5, ["view", "purchase", "error", "click"][k % 4], k * 0.5) for k in range(200)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").repartition(5) \
        .write.parquet(os.path.join(scratch, "events.parquet"))
    from ledgerfleet.sources import bindings as b
    got = E.queries()["script_ingest_stream"](spark, scratch)
    want = cp.script_keys(cp.parse_scripts(b.scripts(spark, scratch))).select(*got.columns)
    assert got.count() == want.count() > 50 and got.exceptAll(want).count() == 0
    got = E.queries()["ledger_state_stream"](spark, scratch)
    want = ll.ledger_state(b.ledger_log(spark, scratch), ["target_id", "version"]).select(*got.columns)
    assert got.count() == want.count() == 10 and got.exceptAll(want).count() == 0
