"""The script tree source (S1, ST2): listing by tasks, pruning, whole texts, streams."""

import json
import os
import time

from pyspark.sql import functions as F

from ledgerfleet.operators import corpus as cp
from ledgerfleet.sources import script_tree as tree
from ledgerfleet.sources.corpus import read_corpus
from ledgerfleet.streaming import streams as st


def write(root, files):
    for rel, body in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(body)


FILES = {"0002_top.sql": b"T;", "a/db/0001_my table.sql": b"A;", "b/db/0001_my table.sql": b"-- UP\nB;\n-- DOWN\nC;",
         "c d/R__v+é%20.sql": b"V;\r\n", "b/.sql": b"x", "b/notes.txt": b"x", "b/0003_up.SQL": b"x",
         "b/empty.sql": b"", "b/bytes.sql": b"\xff\xfe;", "b/db/deep/er/0009_z.sql": "é𝒳;".encode()}


def rows(df):
    return sorted((r.target_id, r.path, r.body) for r in df.select("target_id", "path", F.hex(F.col("body").cast("binary")).alias("body")).collect())


def test_tree_equals_the_text_reader(spark, scratch):
    root = os.path.join(scratch, "my fleet+1")
    write(root, FILES)
    for own in (root, root + "/", "file://" + root):
        got = rows(tree.read_fleet(spark, own))
        assert ("b", "empty.sql", "") in got                                 # the text reader drops empty files
        assert [r for r in got if r[1] != "empty.sql"] == rows(read_corpus(spark, root))
    for tasks in (1, 2, 200):
        listing = tree.list_scripts(spark, root, tasks=tasks)
        assert {(r.target_id, r.path): r.bytes for r in listing.collect()} == {
            tuple(os.path.split(p)): len(b) for p, b in FILES.items() if p.endswith(".sql") and not p.endswith("/.sql")}
    parsed = cp.script_keys(cp.parse_scripts(tree.read_fleet(spark, root).where("path <> 'empty.sql'")))
    assert parsed.exceptAll(cp.script_keys(cp.parse_scripts(read_corpus(spark, root)))).count() == 0


def test_tree_names_that_the_text_reader_skips_and_missing_roots(spark, scratch):
    write(scratch, {"db/_0001_a.sql": b"A;", "db/.b.sql": b"B;", "_db/0001_c.sql": b"C;", "db/0001_d.sql/0002_e.sql": b"E;"})
    got = sorted((r.target_id, r.path) for r in tree.list_scripts(spark, scratch).collect())
    assert got == [("_db", "0001_c.sql"), ("db", ".b.sql"), ("db", "_0001_a.sql"), ("db/0001_d.sql", "0002_e.sql")]
    for gone in ("missing", "db/_0001_a.sql"):
        assert tree.read_fleet(spark, os.path.join(scratch, gone)).collect() == []


def test_tree_targets_limit_what_is_walked(spark, scratch):
    write(scratch, {f"db{k}/sub/000{k}_a.sql": b"A;" for k in range(9)} | {"0001_top.sql": b"T;", "db7/other/0001_a.sql": b"A;"})

    def planned(**options):
        return sorted(n for p in tree.Tree({"path": scratch, **options}).planned() for n in p.names)

    everything = sorted([""] + [f"db{k}" for k in range(9)])
    cases = [({}, everything, 11), ({"targets": ["db3/sub"]}, ["db3"], 1), ({"targets": ["db1/sub", "db5/sub", "none"]}, ["db1", "db5"], 2),
             ({"targets": [""]}, [""], 1), ({"targets": ["db3", "sub"]}, ["db3"], 0), ({"targets": []}, [], 0),
             ({"prefix": "db7"}, ["db7"], 2), ({"prefix": "db7/s"}, ["db7"], 1), ({"prefix": "d"}, everything[1:], 10),
             ({"prefix": "db7/s", "targets": ["db7/other", "db7/sub"]}, ["db7"], 1)]
    for asked, folders, n in cases:
        options = {k: v if isinstance(v, str) else json.dumps(v) for k, v in asked.items()}
        assert planned(**options) == folders, asked
        assert tree.read_fleet(spark, scratch, **asked).count() == n, asked


def test_tree_frame_is_reused_under_other_filters(spark, scratch):
    write(scratch, {f"db{k}/000{k}_a.sql": b"A;" for k in range(9)})
    files = tree.list_scripts(spark, scratch)
    one, two = files.where("target_id = 'db3'"), files.where("target_id = 'db5'")
    assert one.count() == 1 and files.count() == 9 and one.union(two).count() == 2
    assert files.alias("a").join(one.alias("b"), F.col("a.target_id") == F.col("b.target_id")).count() == 1


def test_tree_driver_holds_folder_names_only(spark, scratch):
    write(scratch, {f"hot/{k:04d}_a.sql": b"A;" for k in range(3000)} | {f"t{k}/0001_a.sql": b"B;" for k in range(20)})
    plan = tree.Tree({"path": scratch, "tasks": "4"}).planned()
    assert sorted(n for p in plan for n in p.names) == sorted(["", "hot"] + [f"t{k}" for k in range(20)])
    assert max(len(p.names) for p in plan) <= 6
    # a hot target's files are read by all tasks
    files = tree.list_scripts(spark, scratch)
    spread = (tree._bodies(files, scratch, 8).where("target_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count())
    counts = [r["count"] for r in spread.collect()]
    assert len(counts) == 8 and sum(counts) == 3000 and max(counts) < 600
    assert tree.read_fleet(spark, scratch).count() == 3020


def test_tree_stream_over_restarts_and_edits(spark, scratch):
    src, sink, ck = (os.path.join(scratch, x) for x in ("src", "sink", "ck"))
    seen = []

    def run():
        st.run_to_completion(st.start_script_ingest_stream(tree.stream_scripts(spark, src, settle=0), sink, ck))
        return sorted((r.target_id, r.path) for r in spark.read.parquet(sink).collect())

    write(src, {"db1/0001_a.sql": b"-- UP\nA;\n-- DOWN\nB;", "db1/0002_b.sql": b"C;"})
    seen += [("db1", "0001_a.sql"), ("db1", "0002_b.sql")]
    assert run() == sorted(seen)
    assert run() == sorted(seen)                                            # nothing new: nothing twice
    time.sleep(0.05)
    write(src, {"db2/R__v.sql": b"V;", "db1/0002_b.sql": b"C; D;"})          # a new target, an edited file
    seen += [("db2", "R__v.sql"), ("db1", "0002_b.sql")]
    assert run() == sorted(seen)
    batch = cp.script_keys(cp.parse_scripts(read_corpus(spark, src)))
    assert batch.exceptAll(spark.read.parquet(sink).select(*batch.columns)).count() == 0
    future = time.time() + 3600                                             # not settled: waits for its time
    write(src, {"db3/0001_c.sql": b"C;"})
    os.utime(os.path.join(src, "db3/0001_c.sql"), (future, future))
    assert run() == sorted(seen)
