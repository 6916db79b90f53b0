"""WARC round trips, packing, exact top-k and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerfleet.llm import packing, pii, quality, queries, topk, warc
from tests.llm.edge import documents, empty, texts
from tests.llm.test_dedup import judged, linked
from tests.oracle_harness import duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    want = duck(SF).execute(queries.ORACLE[name]).df()
    own = got.toPandas()
    assert sorted(own.columns) == sorted(want.columns)
    key = lambda frame: sorted(map(repr, frame[sorted(want.columns)].astype(object).where(frame.notna(), None)
                                   .itertuples(index=False, name=None)))
    assert key(own) == key(want)


def pages(spark):
    big, small = "é" * 600, "x" * 999
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/4\r\nX: y", small),
            (5, "http://a/5", small), (6, "u", None), (7, "u", ""), (3, None, big), (None, "u", big), (8, "u", "WARC/1.1 \x1f"),
            (9, "u", "r" * 3_000_000), (10, "u", "".join(random.Random(1).choices("abcdef0123456789", k=2_000_000)))]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record_type int")


@pytest.mark.parametrize("split", [1 << 23, 777, 64])
def test_warc_round_trip(spark, split):
    rows, frame = pages(spark)
    records = warc.read_warc(spark, warc.write_warc(frame.where("page_id is null or page_id < 9 or 64 < %d" % split)), split)
    got = records.select(warc.page_of(F.col("record_id")).alias("page_id"), "target_uri", "record_type",
                         warc.page_of(F.col("refers_to")).alias("refers_to"), "http_length", "payload").collect()
    kept = [r for r in rows if split > 64 or r[0] is None or r[0] < 9]
    assert len(got) == len(kept)
    for r in got:
        own = next(x for x in kept if x[0] == r["page_id"])
        payload = (own[2] or "").encode()
        folded = own[2] is not None and len(payload) >= 1000 and r["page_id"] != 3 and own[2][0] == "é"
        assert r["record_type"] == ("revisit" if folded else "response")
        assert r["refers_to"] == (3 if folded else None) and r["http_length"] == len(payload)
        assert r["payload"] is None if folded else bytes(r["payload"]) == payload
        assert r["target_uri"] == (own[1] and own[1].replace("\r\n", "%0D%0A"))


def test_warc_without_pages(spark):
    _, frame = pages(spark)
    manifest = warc.write_warc(frame.limit(0))
    assert manifest.count() == 0 and warc.read_warc(spark, manifest).count() == 0


def test_warc_false_magic_is_passed_over():
    record = warc.encode_record(1, None, b"abc", "0" * 40, None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    other = packer.compress(b"no warc record") + packer.flush()
    data = b"\x1f\x8b\x08" + other + record + warc.MAGIC * 5 + record

    class File:
        def read_at(self, n, at):
            return data[at:at + n]

    for cut in range(1, len(data)):
        found = [*warc.members(File(), len(data), 0, cut), *warc.members(File(), len(data), cut, len(data))]
        assert len(found) == 2 and all(f.startswith(b"WARC/1.1") for f in found)


def test_packing_hard_cases(spark):
    from tokenizers import Tokenizer
    tokenizer, rows = Tokenizer.from_file(packing.tokenizer_path()), texts()
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k, s, len(ids[s:s + 4096]), zlib.crc32(np.array(ids[s:s + 4096], "<u4").tobytes()))
                 for k, s in enumerate(range(0, len(ids), 4096))]
    got = packing.pack_documents(documents(spark, rows)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    filled = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in filled.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 4096
    assert packing.pack_documents(empty(spark)).count() == 0


def test_word_encoder_is_the_tokenizer():
    encoder = packing.WordEncoder(packing.tokenizer_path(), memo_words=50)
    rnd = random.Random(2)
    own = ["".join(rnd.choice("abcXYZ éÄß'st.,!?&*012\n\t\r-<|>\"") for _ in range(rnd.randint(0, 80))) for _ in range(3000)]
    own += ["it's we're I'LL 'd", "Σίσυφος", "é", "a b", "\x1c x", "½²", "<|startoftext|>"]
    assert encoder.encode(own) == encoder._ids(own)


def test_best_two_fit_packs_every_piece_tightly():
    rnd = random.Random(8)
    for top in (64, 700, 4096):
        histogram = {}
        for _ in range(3000):
            n = min(top, max(1, int(rnd.lognormvariate(5, 1.2))))
            histogram[n] = histogram.get(n, 0) + 1
        plan = packing.best_two_fit(histogram, top)
        length = np.repeat(list(histogram), list(histogram.values()))
        number = np.concatenate([np.arange(n) for n in histogram.values()])
        sequence, offset = plan.place(length, number)
        order = np.lexsort((offset, sequence))
        s, o, n = sequence[order], offset[order], length[order]
        assert ((o == 0) | (np.append(0, (o + n)[:-1]) == o)).all() and (o + n).max() <= top
        assert len(set(sequence)) == plan.sequences <= 1.02 * length.sum() / top + 1


def test_two_smaller_documents_replace_the_smallest():
    # 7 takes 2 greedily (gap 1); 2 gives way to 2 + 1 or, tighter still, the pair that fills 3
    counts = np.zeros(11, dtype=np.int64)
    counts[[6, 3, 2]] = [1, 1, 2]
    assert packing._fill(counts, sum(1 << k for k in (6, 3, 2)), 10) == [6, 2, 2]


def brute_topk(rows, k, every):
    whole = lambda x: int(max(-topk.WIDEST, min(topk.WIDEST, float(np.floor(64.0 * x)))))
    own = [(n, i, [whole(x) for x in v]) for n, (i, v) in enumerate(rows)
           if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for n, i, v in own:
        if i % every == 0:
            found = sorted((-max(-topk.LONG, min(topk.LONG, sum(a * b for a, b in zip(v, w)))), j)
                           for m, j, w in own if len(w) == len(v) and m != n)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


HARD_VECTORS = [(300, None), (None, [0.5] * 8), (305, [0.1, None] * 4), (310, [float("nan")] * 8), (315, [float("inf")] * 8),
                (320, []), (321, []), (325, []), (330, [1.0, 2.0]), (340, [2.0, 1.0]), (350, [1e6] * 8), (355, [-1e6] * 8)]


@pytest.mark.parametrize("shard", [7, 50, 10_000])
def test_topk_hard_cases(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "LEAF_ROWS", 4)
    rnd = random.Random(3)
    rows = [(k, [rnd.gauss(0, 0.3) for _ in range(8)]) for k in range(200)]
    rows += [(k, [0.5] * 8) for k in range(200, 260)]                       # one vector, many copies: ties
    # components far beyond 32 and 53 bits
    rows += [(k, [rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(20, 33) for _ in range(8)]) for k in range(400, 440)]
    rows += [(450, [1e15, 1.0, -1e15] + [0.0] * 5), (455, [1e15, 2.0, 1e15] + [3.0] * 5), (460, [1e300] * 8), (465, [-1.7e308] * 8)]
    rows += HARD_VECTORS
    rows += rows[:3] + rows[5:6] + [(200, [0.5] * 8)] * 3                    # repeated rows, queries among them
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows],
                                  "vec_id long, embedding array<double>, label int, score long")
    vectors = topk.integer_vectors(frame)
    got = topk.top_k(vectors, vectors.where("vec_id % 5 = 0"), 6, shard).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 6, 5)
    none = topk.integer_vectors(frame.limit(0))
    assert topk.top_k(none, none, 6).count() == 0


def test_topk_equals_its_sql_on_repeated_empty_and_large_vectors(spark, scratch):
    rnd = random.Random(8)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(4)]) for k in range(120)] + HARD_VECTORS
    rows += [(k, [rnd.choice([-1, 1]) * 2.0 ** rnd.uniform(18, 24) for _ in range(4)]) for k in range(400, 440)]
    rows += rows[:21] + [(20, rows[20][1])] * 2
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{scratch}/embeddings.parquet")
    con = duck(SF)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{scratch}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute("SELECT query_id, rank, vec_id, score FROM (" + queries.ORACLE["op9_exact_topk"] + ")").fetchall())
    got = queries.QUERIES["op9_exact_topk"](spark, scratch).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == want


def test_one_shard_to_a_task(spark):
    rows = spark.range(64).select(F.col("id").cast("int").alias("shard")).repartitionById(64, "shard")
    assert rows.groupBy(F.spark_partition_id()).count().where("count > 1").count() == 0


def test_kd_tree_boxes_and_pruning():
    rng = np.random.default_rng(1)
    points = rng.integers(-50, 50, (5000, 3)).astype(np.int32)
    tree = topk.KdTree.build(np.arange(5000), points, 32)
    for n, (first, last) in enumerate(tree.rows):
        own = tree.points[first:last]
        assert (own.min(axis=0) == tree.low[n]).all() and (own.max(axis=0) == tree.high[n]).all()
    opened = []
    scan = topk.KdTree.products
    tree_scan = lambda self, a, b, q: opened.append(b - a) or scan(self, a, b, q)
    topk.KdTree.products = tree_scan
    try:
        q = np.array([30.0, -10.0, 5.0])
        best = tree.best(q, tree.bounds(q[None])[0], -1, 5, -(1 << 62))
    finally:
        topk.KdTree.products = scan
    want = sorted(((int(s), i) for i, s in enumerate(points.astype(np.int64) @ q.astype(np.int64))),
                  key=lambda x: (-x[0], x[1]))[:5]
    assert best == want and sum(opened) < 1500


def test_pipeline_equals_its_stages_by_hand(spark, monkeypatch):
    """Every stage against a plain version of it on the stage's own input."""
    nets = []
    fit = queries.quality_net
    monkeypatch.setattr(queries, "quality_net", lambda *a: nets.append(fit(*a)) or nets[-1])
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        steps[name] = ([tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()])
        docs = spark.createDataFrame(steps[name][1], out.schema)
    before, after = steps["quality"]
    scores = quality.probabilities((r[1] or "" for r in before), nets[0])
    assert sorted(after, key=str) == sorted((r for r, s in zip(before, scores) if s >= 0.3), key=str)
    before, after = steps["near_dedup"]
    first = {i for i, _, c in linked([r[:2] for r in before]) if i == c}
    assert sorted(after, key=str) == sorted((r for r in before if r[0] in first), key=str)
    before, after = steps["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {i for i, n, h, _ in judged([r[:2] for r in before], items) if h and 20 * h >= n}
    assert sorted(after, key=str) == sorted((r for r in before if r[0] not in bad), key=str)
    before, after = steps["pii"]
    automaton = pii.anchors()
    want = []
    for r in before:
        text = pii.mask(r[1], pii.find_spans(r[1], automaton)) if r[1] else r[1]
        want.append((r[0], text, *r[2:4], len(text)))
    assert sorted(after, key=str) == sorted(want, key=str)
    before, after = steps["packing"]
    assert {r[0] for r in after} == {r[0] for r in before}


def test_pipeline_on_hard_cases(spark, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for name, rows in (("hard", texts()), ("none", [])):
        d = str(tmp_path / name)
        documents(spark, rows).select(columns).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame([(1, 1, 0), (9, 1, 0), (13, 0, 0)], "doc_id long, quality int, toxic int") \
            .write.parquet(f"{d}/labels.parquet")
        got = corpus_pipeline.run(spark, d)
        assert (got.count() > 0) == bool(rows)
        assert got.columns == [c.split()[0] for c in packing.PLACED.split(", ")]


