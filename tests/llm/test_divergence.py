"""Source divergence: against a plain count by hand, against its SQL, hard cases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerfleet.llm import divergence as dv
from ledgerfleet.llm import queries
from tests.llm import edge
from tests.oracle_harness import compare, duck

DOCS = "doc_id long, text string, lang string, source string, term string, p long"


def brute(rows, min_docs):
    fold = {65 + i: 97 + i for i in range(26)}
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        key = (lang or "", source or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(fold))
        groups.add(key)
        n[key].update(words)
        docs[key[0]].update(set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(n[g])

        def rates(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {g[1]: rates(n[g]) for g in groups if g[0] == lang}
        q = rates(whole)
        for s in p:
            apart = {o: sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept) for o in p if o != s}
            more = {t: (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]}
            for part, items, most in (("pair", apart, None), ("term", more, 10)):
                best = sorted(items.items(), key=lambda kv: (-kv[1], kv[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(best, 1)}
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n, sources, langs=("en", "de", None), words=60):
    rnd = random.Random(seed)
    vocabulary = [rnd.choice(["wort", "Word", "é", "ÅB", "中文", "x"]) + "abcdefgh"[k % 8] * (1 + k // 8) for k in range(words)]
    out = []
    for k in range(n):
        source = rnd.choice(sources)
        own = vocabulary[hash(str(source)) % 7:] if rnd.random() < 0.7 else vocabulary
        text = None if rnd.random() < 0.05 else " ".join(rnd.choices(own, k=rnd.randrange(30))) + rnd.choice([" 12!", "", "."])
        out.append((k, text, rnd.choice(langs), source, "clash", 1))
    return out


@pytest.mark.parametrize("blocks", [(32, 8192), (3, 8192), (32, 4), (2, 3), (1, 1)])
def test_sums_equal_a_count_by_hand_at_any_block_size(spark, blocks):
    rows = corpus(1, 400, [f"src{k}" for k in range(7)] + [None])
    got = rows_of(dv.audit(spark.createDataFrame(rows, DOCS).repartition(5), 5, *blocks))
    assert got == brute(rows, 5)


def test_hot_source_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD_TERMS", 10)
    rows = corpus(2, 300, ["hot"] * 20 + ["a", "b", "c"], langs=("en",))
    assert rows_of(dv.audit(spark.createDataFrame(rows, DOCS).repartition(3))) == brute(rows, 10)


def test_no_kept_terms_and_empty_groups(spark):
    rows = [(1, "only here", "fr", "a", "", 0), (2, None, "fr", "b", "", 0), (3, "", "fr", None, "", 0),
            (4, "alone", "it", "a", "", 0), (5, None, None, None, "", 0)]
    got = rows_of(dv.audit(spark.createDataFrame(rows, DOCS)))
    assert got == brute(rows, 10)
    assert {r[4] for r in got} == {0} and len(got) == 6


def test_a_group_without_kept_terms_has_the_rate_of_count_zero(spark):
    rows = [(k, "same words here", "en", "a", "", 0) for k in range(12)] + [(50, None, "en", "b", "", 0), (51, "12", "en", "c", "", 0)]
    got = rows_of(dv.audit(spark.createDataFrame(rows, DOCS)))
    assert got == brute(rows, 10)


def test_ties_repeated_rows_and_a_long_text(spark):
    rows = [(k % 3, t, "en", s, "", 0) for k in range(11) for t, s in
            (("b a É z", "x"), ("b a É z", "y"), ("z " * 50_000, "z"), ("Z q", "y"))]
    assert rows_of(dv.audit(spark.createDataFrame(rows, DOCS))) == brute(rows, 10)


def test_edge_documents_and_empty_table(spark):
    assert rows_of(dv.audit(edge.documents(spark), 2)) == brute(
        [(i, t, None if i is None else ("en", "de")[i % 2], "src0") for i, t in edge.texts()], 2)
    assert dv.audit(edge.empty(spark)).count() == 0


def test_rates_are_exact_beyond_64_bit_products(spark):
    rnd = random.Random(3)
    rows = [(rnd.randrange(10**15), 10**15 + rnd.randrange(10**17), rnd.randrange(1, 10**9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "n long, total long, kinds long")
    for n, total, kinds, p in df.select("*", dv.rate(F.col("n"), F.col("total"), F.col("kinds")).alias("p")).collect():
        assert p == 1 + 1_000_000_000 * (n + 2) // (total + 2 * kinds)


def test_matches_its_sql(spark):
    d = "/root/testdata/sf0.001"
    r = compare(spark, duck(d), d, "op13", queries.op13_source_divergence, queries.ORACLE["op13_source_divergence"])
    assert r["ok"], r
