"""Language identification by words first, backing off to character n-grams.

Training counts the words of every training document per language, and the
character n-grams (1 to 5, word ends marked) of those words.  A known word
scores its log frequency in each language; an unseen word scores the mean log
frequency of its longest known n-grams: all of its 5-grams that are known, if
none is the 4-grams, and so on.  A text's language has the largest sum over
its words; its score is the share of that language (softmax of the sums).

All counts are complete: every word and n-gram of the training documents counts,
whatever the size of the corpus, and every sum is made of whole numbers (log
frequencies times ``SCALE``), so no order of additions changes it.  The most
frequent words (at most ``MOST_WORDS``) go to the tasks as a fast path.  The other words of
a document are joined by Spark: the distinct ones meet the complete word
counts, those that no training document holds are cut into n-grams, longest first,
and meet the complete n-gram counts, and the scores go back to the documents.
The fast path changes how much is joined and nothing else.

Null texts and texts without a letter of their own are ``und`` with score 0;
so is every text if there is no labelled training document.  A word without any known
letter adds nothing.  Of equal sums the first
language in alphabetical order wins.  Repeated documents count as often as
they occur.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, share, sub_batches

UNKNOWN = "und"
ORDERS = (5, 4, 3, 2, 1)
MOST_WORDS = 1 << 18          # of the fast path
FLUSH_ENTRIES = 200_000       # distinct entries a task counts before it hands them on
MEMO_RUNS = 200_000           # runs without white space a task remembers the scores of
COUNT_BYTES = 6 << 20         # text whose different runs are looked at together
SMOOTHING = 0.5
SCALE = 1 << 20               # log frequencies are whole multiples of 1 / SCALE

_WORD = re.compile(r"[^\W\d_]+")
COUNTS = "lang string, word string, n long"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def white_space_runs(texts: list[str]) -> pa.Array:
    """Lower-cased texts cut at white space; no word lies across a cut."""
    return pa.compute.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))


def grams(word: str, order: int) -> list[str]:
    """The n-grams of a word between end marks; its single letters if n is 1."""
    own = word if order == 1 else f"<{word}>"
    return [own[k:k + order] for k in range(len(own) - order + 1)]


def _batch(lang: list[str], word: list[str], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())],
                                      names=["lang", "word", "n"])


def _flush(held: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
    for lang, own in held.items():
        if own:
            yield _batch([lang] * len(own), list(own), list(own.values()))
    held.clear()


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all rows of ``docs`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {}
        for batch in (part for whole in batches for part in sub_batches(whole, "text", COUNT_BYTES)):
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                counts = held.setdefault(lang, {})
                different = white_space_runs(own).flatten().value_counts()
                for run, n in zip(different.field(0).to_pylist(), different.field(1).to_pylist()):
                    for word in _WORD.findall(run):
                        counts[word] = counts.get(word, 0) + n
            if sum(map(len, held.values())) > FLUSH_ENTRIES:
                yield from _flush(held)
        yield from _flush(held)

    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return (map_batches(labelled.select(F.col("lang").cast("string"), F.col("text").cast("string")), run, COUNTS)
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def gram_counts(counts: DataFrame) -> DataFrame:
    """lang, word (the n-gram; its length is its order), n from word counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {}
        for batch in batches:
            for lang, word, n in zip(*batch.to_pydict().values()):
                own = held.setdefault(lang, {})
                get = own.get
                marked, size = f"<{word}>", len(word) + 2
                for g in word:
                    own[g] = get(g, 0) + n
                for order in ORDERS[:-1]:
                    for k in range(size - order + 1):
                        g = marked[k:k + order]
                        own[g] = get(g, 0) + n
            if sum(map(len, held.values())) > FLUSH_ENTRIES:
                yield from _flush(held)
        yield from _flush(held)

    return (map_batches(counts.select("lang", "word", "n"), run, COUNTS)
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _scores(entries: DataFrame, langs: list[str], totals: dict[str, int], kinds: int) -> DataFrame:
    """word, n, and a column ``s<k>`` per language: the log frequency of the
    entry, of ``entries`` (word, n, by_lang), times ``SCALE``."""
    def score(lang: str) -> Column:
        count = F.coalesce(F.col("by_lang")[lang], F.lit(0)) + SMOOTHING
        return F.round((F.log(count) - F.log(F.lit(totals.get(lang, 0) + SMOOTHING * (kinds + 1)))) * SCALE).cast("long")
    return entries.select("word", "n", *[score(lang).alias(f"s{k}") for k, lang in enumerate(langs)])


def _by_entry(counts: DataFrame, kind: str) -> DataFrame:
    total = counts.groupBy("word").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    return materialize(total, kind)


def _frequent(words: DataFrame, most: int) -> pa.Table:
    """The words seen at least 2**k times, with the smallest k that leaves at
    most ``most``."""
    sizes = {r["k"]: r["c"] for r in words.groupBy(F.floor(F.log2("n")).alias("k")).agg(
        F.count(F.lit(1)).alias("c")).collect()}                       # at most 64 rows
    kept, k = 0, 64
    while k > 0 and kept + sizes.get(k - 1, 0) <= most:
        k -= 1
        kept += sizes.get(k, 0)
    return words.where(F.col("n") >= (1 << k)).drop("n").toArrow()


@dataclass
class LanguageModel:
    """Scores of all words and, by length, of all n-grams; ``frequent`` holds
    those of the fast path."""
    langs: list[str]
    words: DataFrame | None
    grams: dict[int, DataFrame]
    frequent: pa.Table | None

    @property
    def columns(self) -> list[str]:
        return [f"s{k}" for k in range(len(self.langs))]


def fit(docs: DataFrame, most_words: int = MOST_WORDS) -> LanguageModel:
    """Train on ``docs`` (lang, text); rows without either are left out."""
    counts = materialize(word_counts(docs), "lang-words")

    def sizes(rows: DataFrame) -> dict[str, int]:        # a number per language
        return {r["lang"]: int(r["n"]) for r in rows.groupBy("lang").agg(F.sum("n").alias("n")).collect()}

    totals = sizes(counts)
    langs = sorted(totals)
    if not langs:
        return LanguageModel([], None, {}, None)
    entries = _by_entry(counts, "lang-word-totals")
    words = _scores(entries, langs, totals, entries.count())
    all_grams = materialize(gram_counts(counts), "lang-grams")
    grams_of = _by_entry(all_grams, "lang-gram-totals")
    by_order = {}
    for order in ORDERS:
        own = grams_of.where(F.length("word") == order)
        by_order[order] = _scores(own, langs, sizes(all_grams.where(F.length("word") == order)), own.count())
    return LanguageModel(langs, words, by_order, _frequent(words, most_words))


# --- prediction ------------------------------------------------------------------------------

class _FastPath:
    """Sums over the frequent words of texts, and the other words as they are."""

    def __init__(self, frequent: pa.Table, width: int):
        own = frequent.column("word").to_pylist()
        self.row = {w: k for k, w in enumerate(own)}
        self.scores = np.stack([frequent.column(f"s{k}").to_numpy() for k in range(width)], axis=1) if own else \
            np.zeros((0, width), dtype=np.int64)
        self.has_letter = np.array([any(c.isalpha() for c in w) for w in own], dtype=bool)
        self.width = width
        self.memo: dict[str, tuple[np.ndarray, bool, list[str]]] = {}

    def _mixed(self, run: str) -> tuple[np.ndarray, bool, list[str]]:
        """A run that is no frequent word itself: sum, letter, other words."""
        known = self.memo.get(run)
        if known is None:
            found = _WORD.findall(run)
            rows = [self.row[w] for w in found if w in self.row]
            known = (self.scores[rows].sum(axis=0), any(c.isalpha() for c in run), [w for w in found if w not in self.row])
            if len(self.memo) < MEMO_RUNS and len(run) < 64:
                self.memo[run] = known
        return known

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[Counter]]:
        """Of each text the sums, whether it holds a letter, the other words."""
        split = white_space_runs([t or "" for t in texts])
        different = split.flatten().dictionary_encode()
        runs, at = different.dictionary.to_pylist(), different.indices.to_numpy()
        ends = split.offsets.to_numpy()
        row = np.fromiter((self.row.get(r, -1) for r in runs), dtype=np.int64, count=len(runs))
        sums, letters = np.zeros((len(runs), self.width), dtype=np.int64), np.zeros(len(runs), dtype=np.int64)
        sums[row >= 0], letters[row >= 0] = self.scores[row[row >= 0]], self.has_letter[row[row >= 0]]
        others: dict[int, list[str]] = {}
        for k in np.flatnonzero(row < 0).tolist():
            sums[k], letters[k], rest = self._mixed(runs[k])
            if rest:
                others[k] = rest
        whole = np.concatenate([np.zeros((1, self.width), dtype=np.int64), np.cumsum(sums[at], axis=0)])
        lettered = np.concatenate([[0], np.cumsum(letters[at])])
        rest_of: list[Counter] = [Counter() for _ in texts]
        rare = np.zeros(len(runs), dtype=bool)
        rare[list(others)] = True
        places = np.flatnonzero(rare[at])
        for doc, run in zip((np.searchsorted(ends, places, side="right") - 1).tolist(), at[places].tolist()):
            rest_of[doc].update(others[run])
        return whole[ends[1:]] - whole[ends[:-1]], lettered[ends[1:]] > lettered[ends[:-1]], rest_of


def _gram_rows(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, gram, n = [], [], []
            for w in batch.column(0).to_pylist():
                own = Counter(grams(w, order))
                word += [w] * len(own)
                gram += own
                n += own.values()
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(gram, pa.string()), pa.array(n, pa.int64())],
                                             names=["unseen", "word", "n"])
    return run


def _back_off(unseen: DataFrame, model: LanguageModel) -> DataFrame:
    """word and its scores: the mean over its longest known n-grams.  Words
    without a known letter are not among the rows."""
    found, left = None, materialize(unseen, "lang-unseen")
    for order in ORDERS:
        pieces = map_batches(left, _gram_rows(order), "unseen string, word string, n long").withColumnRenamed("n", "times")
        own = (pieces.join(model.grams[order], "word").groupBy("unseen").agg(
            *[F.floor(F.sum(F.col(c) * F.col("times")) / F.sum("times")).alias(c) for c in model.columns])
            .withColumnRenamed("unseen", "word"))
        own = materialize(own, "lang-backed-off")
        found = own if found is None else found.unionByName(own)
        left = materialize(left.join(own, "word", "left_anti"), "lang-unseen")
        if left.isEmpty():
            break
    return found


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs``, from its text alone."""
    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if not model.langs:
        return asked.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    columns, width = model.columns, len(model.langs)
    shared = share(docs.sparkSession, model.frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fast = _FastPath(shared(), width)
        for batch in (part for whole in batches for part in sub_batches(whole, "text", COUNT_BYTES)):
            sums, letters, rest = fast.read(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(letters), *[pa.array(sums[:, k]) for k in range(width)],
                 pa.array([list(r) for r in rest], pa.list_(pa.string())),
                 pa.array([list(r.values()) for r in rest], pa.list_(pa.int64()))],
                names=["doc_id", "letters", *columns, "words", "times"])

    schema = ", ".join(["doc_id long, letters boolean", *[f"{c} long" for c in columns], "words array<string>, times array<long>"])
    base = materialize(map_batches(asked, run, schema).withColumn("row", F.monotonically_increasing_id()), "lang-read")
    tail = (base.select("row", F.explode(F.arrays_zip("words", "times")).alias("t"))
            .select("row", F.col("t.words").alias("word"), F.col("t.times").alias("times")))
    different = materialize(tail.select("word").distinct().join(model.words.drop("n"), "word", "left"), "lang-tail")
    seen = F.col(columns[0]).isNotNull()
    scores = different.where(seen).unionByName(_back_off(different.where(~seen).select("word"), model))
    added = tail.join(scores, "word").groupBy("row").agg(*[F.sum(F.col(c) * F.col("times")).alias(f"t{c}") for c in columns])
    sums = base.select("row", "doc_id", "letters", *columns).join(added, "row", "left").select(
        "doc_id", "letters", *[(F.col(c) + F.coalesce(f"t{c}", F.lit(0))).alias(c) for c in columns])
    best = F.greatest(*columns) if width > 1 else F.col(columns[0])
    lang = F.lit(model.langs[-1])
    for k in range(width - 2, -1, -1):
        lang = F.when(F.col(columns[k]) == F.col("best"), model.langs[k]).otherwise(lang)
    others = sum((F.exp((F.col(c) - F.col("best")) / F.lit(float(SCALE))) for c in columns), F.lit(0.0))
    return sums.withColumn("best", best).select(
        "doc_id", F.when(F.col("letters"), lang).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), 1 / others).otherwise(0.0).alias("score"))
