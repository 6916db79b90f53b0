"""Suffix dedup, SimHash near-dedup and decontamination against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerfleet.llm import common, decontam, queries, simhash, suffix_dedup
from tests.llm.edge import LINE, documents, empty, prose, texts

SF = "/root/testdata/sf0.001"
LOWER = {65 + i: 97 + i for i in range(26)}


def sf_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def cut(rows):
    """doc_id, removed, spans, sha256 of the rest, by a dictionary of all strings."""
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            if i is not None and first.get(raw[p:p + 50], i) >= i:
                first[raw[p:p + 50]] = i
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 2, dtype=bool)
        for p in range(len(raw) - 49):
            if i is not None and first[raw[p:p + 50]] < i:
                gone[1 + p:51 + p] = True
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone[1:-1]])
        out.append((i, len(raw), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(spark, docs):
    done = suffix_dedup.deduplicated(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long"), F.size("runs").cast("long"),
        F.sha2("kept", 256))
    return sorted(map(tuple, done.collect()), key=str)


def test_suffix_dedup_query_equals_brute_force(spark):
    got = queries.QUERIES["op2_suffix_dedup"](spark, SF).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == cut(sf_rows(spark))


def test_suffix_dedup_hard_cases(spark, monkeypatch):
    rows = texts()
    assert removed(spark, documents(spark, rows)) == cut(rows)
    # small blocks, buckets and memories take the same decisions
    for name, value in (("BLOCK", 256), ("BUCKET_ROWS", 3), ("LEAD_ROWS", 4), ("HOT_DOCS", 3), ("SEEN_STRINGS", 5)):
        monkeypatch.setattr(suffix_dedup, name, value)
    assert removed(spark, documents(spark, rows)) == cut(rows)


def test_long_leads_go_by_in_parts(spark, monkeypatch):
    """One lead in every document, more rows than a bucket may hold at once."""
    for name, value in (("LEAD_ROWS", 8), ("BUCKET_ROWS", 8), ("HOT_DOCS", 10 ** 9)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = [(k, f"{prose(k, 6)} {LINE} {prose(k + 500, 6)}") for k in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    monkeypatch.setattr(common, "ARROW_BATCH_ROWS", 5)
    assert removed(spark, documents(spark, rows)) == cut(rows)


@pytest.mark.parametrize("hot_docs", [2, 10 ** 9])
@pytest.mark.parametrize("block", [1 << 9, 1 << 18])
def test_runs_and_repeated_lines_inside_documents(spark, monkeypatch, hot_docs, block):
    for name, value in (("BLOCK", block), ("HOT_DOCS", hot_docs), ("BUCKET_ROWS", 50), ("LEAD_ROWS", 60)):
        monkeypatch.setattr(suffix_dedup, name, value)
    sheet, comb = (prose(7, 30) + "\n")[:130], "-=" * 700
    rows = [(1, "x" * 3000), (2, prose(1, 9) + "x" * 2000 + prose(2, 9)), (3, comb), (4, "y" + comb[1:900] + "z"), (5, "x" * 49),
            (6, sheet * 40), (7, sheet * 12 + "!" + sheet[40:] * 9 + "x" * 60), (8, "".join(sheet + prose(k, 3) for k in range(30))),
            (9, (sheet[20:90] + "\n") * 30), (10, " " * 4000), (11, "a" + " " * 51 + "b" + " " * 90 + sheet[:60] * 3), (11, " " * 70),
            (12, "x" * 1500 + " " * 1500 + "x" * 1500)]
    rows += [(20 + k, prose(k, 5) + "=" * (60 + 7 * k) + prose(k + 50, 5) + "\n" + LINE * 3) for k in range(12)]
    assert removed(spark, documents(spark, rows)) == cut(rows)


def test_long_runs_travel_in_few_rows(spark):
    line = "=" * 1000 + "\n"
    rows = [(1, "x" * 3_000_000), (2, "a" + "x" * 2_000_000 + "b"), (3, line * 2000), (4, "c" + line * 1000 + "d")]
    docs = documents(spark, rows).select("doc_id", "text")
    none = np.zeros(0, dtype=np.uint64)
    found = suffix_dedup.suffixes(docs, none, none)
    assert found.count() < 2000                                   # 8 MB, an anchor at almost every byte
    hot = np.unique(suffix_dedup.lead_hashes(suffix_dedup.big_endian(np.frombuffer(b"x" * 99 + b"=" * 99, dtype=np.uint8))))
    assert suffix_dedup.suffixes(docs, none, np.sort(hot)).count() < 20_000
    got = {r[0]: r[2:4] for r in removed(spark, docs)}
    assert got == {1: (0, 0), 2: (2_000_000, 1), 3: (0, 0), 4: (1000 * 1001, 1)}


def test_places_of_equal_pieces():
    place = np.array([5, 6, 7, 9, 40, 71, 72, 3, 100])
    one, again = suffix_dedup.gathered_places(np.array([0] * 8 + [1]), place, [b"a"] * 7 + [b"b", b"a"])
    assert one == [0, 7, 8] and again[1:] == [None, None]
    assert sorted(set(suffix_dedup.all_places(again[0]).tolist())) == [5, 6, 7, 9, 40, 71, 72]


def test_suffix_dedup_without_rows(spark):
    assert removed(spark, empty(spark)) == []


def test_equal_strings_find_all_runs():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[1500:1600] = data[100:200]
    start = np.arange(len(data) - 60)
    rows, run = suffix_dedup.equal_strings(data, start, np.zeros(len(start), dtype=np.int64))
    strings = {}
    for s in start:
        strings.setdefault(data[s:s + 50].tobytes(), set()).add(int(s))
    groups = {}
    for r, g in zip(rows, run):
        groups.setdefault(int(g), set()).add(int(start[r]))
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in strings.values() if len(v) > 1)


def fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[k:k + width]) for k in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(rows, bits=3):
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= bits:
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, format(prints[k], "016x"), least.get(root(k))) for k, (i, _) in enumerate(rows)), key=str)


def test_simhash_query_equals_brute_force(spark):
    got = queries.QUERIES["op8_simhash_near_dedup"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == linked(sf_rows(spark))


@pytest.mark.parametrize("small", [False, True])
def test_simhash_hard_cases(spark, monkeypatch, small):
    base = prose(7, 400).split()
    near = [(1000 + k, " ".join(base[:k] + ["x"] + base[k:])) for k in range(120)]
    rows = texts() + near
    if small:      # many leaves, many blocks, local trees
        for name, value in (("LEAF_ROWS", 4), ("BLOCK_ROWS", 8), ("LOCAL_ROWS", 2)):
            monkeypatch.setattr(simhash, name, value)
    got = simhash.near_duplicates(documents(spark, rows)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == linked(rows)


def test_vantage_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    flips = np.array([sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))) for _ in range(2000)], dtype=np.uint64)
    fps = np.unique(seeds[rng.integers(0, 40, 2000)] ^ flips)
    pairs = {(a, b) for a in range(len(fps)) for b in range(a)
             if bin(int(fps[a] ^ fps[b])).count("1") <= 3}
    met = set()
    for half in (0, 1):
        values = simhash.halves(fps, half)
        tree = simhash.fit_tree(values, 16, 1)
        assert tree.leaves > 1
        for _, home, reach in tree.route(values, 1):
            met |= {(max(a, b), min(a, b)) for a in home.tolist() for b in reach.tolist() if a != b}
    assert pairs <= met


def test_first_of_each_group(spark):
    rows = [(3, "a b c d"), (2, "a b c d"), (2, "a b c d"), (9, "other words stand here"), (None, "a b c d")]
    kept = simhash.first_of_each_group(documents(spark, rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(2, "a b c d"), (9, "other words stand here"), (None, "a b c d")], key=str)
    assert simhash.first_of_each_group(empty(spark)).count() == 0


def judged(rows, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        own = words(t)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[k:k + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in rows:
        own, hit, found = words(t), set(), set()
        for w, ids in windows.items():
            for k in range(len(own) - len(w) + 1):
                if tuple(own[k:k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    found |= ids
        out.append((i, len(own), len(hit), sorted(found)))
    return sorted(out, key=str)


ITEMS = [(1, LINE), (2, "One"), (2, "two words"), (10, "  "), (11, None), (None, "more of it"), (3, prose(2, 30)),
         (4, "ab" * 200)]


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_decontamination_hard_cases(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)     # 60: a block for every item or two
    monkeypatch.setattr(decontam, "SHARD_BYTES", 2000)
    rows = texts()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontam.contamination(documents(spark, rows), items).collect()
    for r in found:                     # the hit words are those under the longest matches
        under = {k for m in r["matches"] for k in range(m["start"], m["start"] + m["n_words"])}
        assert len(under) == r["n_hit"] and len({m["start"] for m in r["matches"]}) == len(r["matches"])
    got = [(r["carried"]["doc_id"], r["n_words"], r["n_hit"], r["items"])
           for r in found]
    assert sorted(got, key=str) == judged(rows, ITEMS)


def test_decontamination_query_equals_brute_force(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(i, n, h, len(f), hashlib.sha256(",".join(f).encode()).hexdigest(), h > 0 and 20 * h >= n)
            for i, n, h, f in judged(sf_rows(spark), items)]
    got = queries.QUERIES["op7_decontamination"](spark, SF).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(w[-1] for w in want)


def test_clean_documents_keep_their_columns(spark):
    docs, items = documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.clean_documents(docs, items)
    assert kept.columns == docs.columns
    bad = {r[0] for r in judged(texts(), ITEMS) if r[2] and 20 * r[2] >= r[1]}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in texts()} - bad
    assert decontam.clean_documents(empty(spark), items).count() == 0
    assert decontam.clean_documents(docs, items.limit(0)).count() == docs.count()


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, f"before {LINE} after"), (2, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(5, f"other start {LINE} other end")], "item_id long, text string")
    rows = decontam.longest_matches(docs, items).collect()
    n = len(decontam.words(LINE))
    assert [tuple(r) for r in rows] == [("5", 2, 1, 1, n)]
