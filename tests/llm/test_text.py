"""PII, language, quality and secrets."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfleet.llm import langid, pii, quality, queries, secrets
from tests.llm.edge import documents, empty, prose, texts

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.1"


def plain_spans(text):
    """The base kinds by regular expressions over the whole text."""
    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits)))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return out


def base(spans):
    return [s for s in spans if s[0] in pii.BASE_KINDS]


def test_pii_equals_the_patterns_on_random_texts():
    automaton, rnd = pii.anchors(), random.Random(5)
    seeds = ["4111111111111111", "4111 1111-1111 1111", "1.2.3.4.5.6.7.8", "+1 (555) 123-4567", "a.b@c.d.e", "@@x@y.z",
             "999.1.1.1", "+1+2 3456789", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 2"]
    for _ in range(20_000):
        text = "".join(rnd.choice("0123456789..--  ++@@ab(:/é4٣") for _ in range(rnd.randint(0, 40)))
        text = rnd.choice(seeds) + text if rnd.random() < 0.4 else text + rnd.choice(seeds)
        assert base(pii.find_spans(text, automaton)) == plain_spans(text), text


def test_pii_extra_kinds_and_mask():
    text = "see https://joe:pw@host.org/x, IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678; a@b.c"
    spans = pii.find_spans(text, pii.anchors())
    assert [text[a:b] for _, a, b in spans] == ["pw@host.org", "a@b.c", "https://joe:pw@host.org",
                                                "DE89 3704 0044 0532 0130 00", "12345678"]
    assert pii.mask(text, spans) == "see [LOGIN]/x, IBAN: [IBAN], account no. [ACCOUNT]; [EMAIL]"
    assert pii.mask("abcdef", [("a", 1, 3), ("b", 2, 5)]) == "a[A]f"
    assert "iban" not in {k for k, *_ in pii.find_spans("IBAN DE00 3704 0044 0532 0130 00", pii.anchors())}


def test_pii_work_is_linear():
    automaton = pii.anchors()
    for text in ("a" * 300_000 + "@", "a@" * 200_000, "1." * 200_000, "1 " * 300_000, "+1 " * 150_000):
        assert base(pii.find_spans(text, automaton)) == plain_spans(text)


def test_pii_query_equals_the_patterns(spark):
    import hashlib
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for i, t in rows:
        own = plain_spans(t or "")
        n = [sum(s[0] == k for s in own) for k in pii.BASE_KINDS]
        want[i] = (*n, hashlib.sha256(",".join("%s:%d:%d" % s for s in own).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
           for r in queries.QUERIES["op6_pii"](spark, SF).collect()}
    assert got == want and any(any(w[:4]) for w in want.values())


def test_pii_hard_cases(spark):
    docs = documents(spark, [*texts(), (50, "é a@b.c"), (51, "a@b.c a@b.c")])
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.personal_spans(docs).collect()}
    assert found[4] == found[5] == [] and found[50] == [("email", 2, 7)] and len(found[51]) == 2
    masked = pii.redacted(docs)
    assert masked.columns == docs.columns
    own = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert own[4] is None and own[50] == "é [EMAIL]" and own[5] == ""
    assert pii.redacted(empty(spark)).count() == 0 and pii.personal_spans(empty(spark)).count() == 0


def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op5_language_id"](spark, MID)
    truth = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang")
    own = got.join(truth, "doc_id").where("held_out").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")).alias("ok")).first()
    assert own["n"] > 2000 and own["ok"] / own["n"] > 0.97


def hand_made_languages(rows, asked):
    """(lang, score) of the texts ``asked`` by counting the training rows
    (lang, text) in dictionaries, word by word."""
    words, by_order = {}, {n: {} for n in langid.ORDERS}
    for lang, text in rows:
        for w in langid.words(text) if lang is not None and text is not None else ():
            words.setdefault(w, Counter())[lang] += 1
            for n in langid.ORDERS:
                for g in langid.grams(w, n):
                    by_order[n].setdefault(g, Counter())[lang] += 1
    langs = sorted({lang for c in words.values() for lang in c})

    def logs(table):
        total = {lang: sum(c[lang] for c in table.values()) for lang in langs}
        return {e: [math.log(c[lang] + 0.5) - math.log(total[lang] + 0.5 * (len(table) + 1)) for lang in langs]
                for e, c in table.items()}

    word_logs, gram_logs = logs(words), {n: logs(t) for n, t in by_order.items()}
    out = []
    for text in asked:
        if not langs or not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        sums = np.zeros(len(langs))
        for w in langid.words(text):
            if w in word_logs:
                sums += word_logs[w]
                continue
            for n in langid.ORDERS:
                known = [gram_logs[n][g] for g in langid.grams(w, n) if g in gram_logs[n]]
                if known:
                    sums += np.mean(known, axis=0)
                    break
        out.append((langs[int(sums.argmax())], 1 / np.exp(np.maximum(sums - sums.max(), -700)).sum()))
    return out


def predicted(spark, model, texts_):
    docs = spark.createDataFrame([(k, t, "x", 3) for k, t in enumerate(texts_)], "doc_id long, text string, word string, row long")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs.repartition(3), model).collect()}
    return [got[k] for k in range(len(texts_))]


def test_language_backs_off_and_handles_hard_cases(spark):
    rows = [("en", "the weather and the water ½ ²"), ("en", "there with the other"), ("de", "das wetter und der wind ½"),
            ("de", None), (None, "the the the"), ("de", "und nicht der hund")]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.langs == ["de", "en"]
    asked = ["weatherly", "hundlich", "12 ... ²", None, "中", "the weather-und", "½", "½ ½ ², 7", "", "the", "½ the",
             "the " * 30_000, "x" * 50_000, "hundlich " * 5]
    got = predicted(spark, model, asked)
    want = hand_made_languages(rows, asked)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-3)
    assert got[0][0] == "en" and got[1][0] == "de"
    assert [got[k] for k in (2, 3, 6, 7, 8)] == [("und", 0.0)] * 5           # no letter of their own
    edge_ = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(documents(spark), model).collect()}
    assert edge_[4] == edge_[5] == edge_[6] == ("und", 0.0) and 0 <= edge_[9][1] <= 1
    assert langid.predict(documents(spark), model).count() == len(texts())
    nothing = langid.fit(empty(spark).select("lang", "text"))
    assert predicted(spark, nothing, ["the"]) == [("und", 0.0)]
    assert langid.predict(empty(spark), model).count() == 0


def test_language_equals_a_count_by_hand_and_the_fast_path_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").orderBy("doc_id").collect()
    train = [(r["lang"], r["text"]) for r in docs if r["doc_id"] % 3]
    asked = [r["text"] for r in docs]
    want = hand_made_languages(train, asked)
    first = None
    for most in (0, 40, 1 << 18):
        model = langid.fit(spark.createDataFrame(train, "lang string, text string"), most)
        assert model.frequent.num_rows <= most
        got = predicted(spark, model, asked)
        assert first in (None, got)                                          # to the last bit
        first = got
    assert [g[0] for g in first] == [w[0] for w in want]
    assert [g[1] for g in first] == pytest.approx([w[1] for w in want], abs=1e-3)


def test_quality_gradients_are_right():
    rng = np.random.default_rng(0)
    net = quality.ByteNet.fresh()
    net.shift += 0.3
    block = rng.integers(97, 123, (3, quality.CHUNK)).astype(np.uint8)
    block[1, 300:] = 0
    label = np.array([1, 0, 1], dtype=np.float32)

    def loss():
        z = net.logits(block).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-z)) * label + np.log1p(np.exp(z)) * (1 - label)))

    for p, g in zip(net.parameters(), net.gradients(block, label)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before, eps = p[at], np.float32(2e-3)
        p[at] = before + eps
        up = loss()
        p[at] = before - eps
        down = loss()
        p[at] = before
        assert (up - down) / (2 * eps) == pytest.approx(g[at], rel=0.1, abs=1e-4)


def test_quality_held_out(spark):
    got = queries.QUERIES["op10_quality_classifier"](spark, MID)
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    own = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    rank = own["score"].rank().to_numpy()
    good = own["quality"].to_numpy() == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.97
    assert (own["predicted"][good] == 1).mean() > 0.98 and (own["predicted"][~good] == 0).mean() > 0.75


def test_quality_hard_cases(spark):
    long = prose(3, 20_000).encode()
    parts = quality.chunks(long)
    assert b"".join(p.tobytes() for p in parts[:1]) + b"".join(p.tobytes()[-quality.STEP:] for p in parts[1:]) \
        == long.ljust((len(parts) - 1) * quality.STEP + quality.CHUNK, b"\0")
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (9, 1), (13, 0), (4, 0), (None, 1), (2, None), (77, 1)],
                                   "doc_id long, label int")
    net = quality.fit(docs, labels, steps=5)
    own = quality.score(docs, net)
    assert own.count() == docs.count() and own.where("score < 0 or score > 1 or score is null").count() == 0
    same = quality.probabilities(iter([long.decode()] * 2 + ["a"]), net, at_once=3)
    assert same[0] == pytest.approx(quality.probabilities(iter([long.decode()]), net)[0], abs=1e-5)
    assert same[0] == pytest.approx(same[1], abs=1e-5)
    assert quality.fit(docs, labels.limit(0)) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.good_documents(docs, net).columns == docs.columns
    assert quality.good_documents(empty(spark), net).count() == 0


def test_quality_sample_stays_bounded_under_a_repeated_labelled_id(spark):
    docs = spark.createDataFrame([(1, f"text {k} " * 40) for k in range(500)] + [(2, "one text " * 400)] * 300 + [(3, "x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, label int")
    blocks, values = quality.training_chunks(docs.repartition(7), labels, 5, 4)
    assert len(blocks) == 20
    again, same = quality.training_chunks(docs.repartition(3), labels, 5, 4)
    assert (blocks == again).all() and (values == same).all()
    blocks, values = quality.training_chunks(docs.where("doc_id > 1"), labels, 5, 4)
    assert len(blocks) <= 5 and (values == 1).all()                 # equal rows count once


def test_held_out_folds(spark):
    import zlib
    rows = spark.range(200).select(quality.held_out("id").alias("a"), quality.held_out("id", 2, 4).alias("b")).collect()
    assert [r["a"] for r in rows] == [zlib.crc32(str(k).encode()) % 5 == 0 for k in range(200)]
    assert [r["b"] for r in rows] == [zlib.crc32(str(k).encode()) % 4 == 2 for k in range(200)]


HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"


def test_secret_findings_hold_their_place(spark):
    rows = [(1, f'ö token = "{HEX}" and {HEX}x=='), (2, HEX), (3, None), (4, ""), (5, "short 123"), (1, HEX), (None, HEX),
            (6, ("word " * 3000) + HEX + " " + HEX)]
    docs = documents(spark, rows)
    got = secrets.findings(docs).collect()
    text = dict(rows[:1] + rows[1:5] + rows[7:])
    assert len(got) == 7
    for r in got:
        own = (text if r["doc_id"] != 1 or r["token"] != HEX or r["start"] else {1: HEX}).get(r["doc_id"], HEX)
        assert own[r["start"]:r["end"]] == r["token"]
    assert secrets.findings(empty(spark)).count() == 0


def test_secret_scan_removes_false_positives(spark):
    got = queries.QUERIES["op3_secret_scan"](spark, MID)
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    known = docs.select("doc_id", F.regexp_extract_all("text", F.lit(r'(?i)token = "([0-9a-f]{40})"'), F.lit(1)).alias("t"))
    planted = known.select("doc_id", F.explode("t").alias("t")).select("doc_id", F.sha2("t", 256).alias("token_sha256"))
    found = got.where("is_secret").select("doc_id", "token_sha256")
    n = planted.distinct().count()
    assert n > 100 and planted.distinct().join(found.distinct(), ["doc_id", "token_sha256"]).count() >= 0.95 * n
    assert found.distinct().count() <= 1.1 * n and got.where("not is_secret").count() > 500


def test_secret_scan_held_out_findings(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = secrets.findings(docs)
    labelled = secrets.labelled_findings(found).withColumn("fold", F.pmod(F.xxhash64("token"), F.lit(4))).cache()
    words = secrets.dictionary(docs).cache()
    pairs = secrets.letter_pairs(words)
    model = secrets.train(labelled.where("fold > 0"), words, pairs)
    rest = labelled.where("fold = 0").withColumn("finding", F.monotonically_increasing_id()).cache()
    own = model.transform(secrets.featured(rest, words, pairs))
    assert own.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.9


def test_secret_scan_runs_on_hard_cases(spark):
    rows = [*texts(), (60, f'token = "{HEX}"'), (61, "/" * 40), (62, "=" * 40), (63, "A" * 5000)]
    got = secrets.scan(documents(spark, rows))
    assert got.where("doc_id = 60 and is_secret").count() == 1
    assert got.where("doc_id in (4, 5, 6, 7)").count() == 0
    assert secrets.scan(empty(spark)).count() == 0
