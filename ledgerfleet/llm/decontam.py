"""Benchmark decontamination by suffix arrays over the training text.

Texts are lower-cased (A-Z only) and cut into words.  A *window* is 13
consecutive words of a benchmark item; an item of fewer words is one window.
A document word is hit if it lies inside an occurrence of any window.

Each task turns its documents, in shards of bounded size, into word numbers of
the benchmark's vocabulary (0: a word no item has) and builds the shard's
suffix array: the positions from which at least a shortest window of known
words follows, sorted by their next 13 word numbers (a suffix that meets an
unknown word or the document's end sooner than the shortest window cannot hold
an occurrence).  Every benchmark suffix is then binary-searched in it; the
range between its lower and upper bound are all verbatim locations.  Where the words
before differ a match begins, and it is extended to the longest verbatim match
from there; the hit words of a document are those of its longest matches, which
are returned with their places.

Documents are never shuffled: a hot source or a passage shared by thousands of
documents only makes ranges longer.  The benchmark is a stated query set; it is
sent in blocks of at most ``BLOCK_BYTES`` of text, from which a task builds some 60
bytes a word besides the vocabulary; there is one pass over the documents per
block, with the matches carried along, so its size is not limited.  A single item beyond a
block is a block of its own.

Null texts have no words and are never contaminated.  Items with a null id take
part under an empty id; items sharing an id count as one.  Repeated documents
are judged one by one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, map_batches, materialize, share, sub_batches

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20

_WORD = re.compile(r"[0-9a-z\x80-\U0010FFFF]+")


def words(text: str) -> list[str]:
    return _WORD.findall(ascii_lower(text))


@dataclass
class Queries:
    """The benchmark suffixes that begin a window: padded word numbers (of
    those shorter than a window also the upper bound), item number, place in the
    item, and window length."""
    vocabulary: dict[str, int]
    lower: np.ndarray
    short: np.ndarray
    short_upper: np.ndarray
    item: np.ndarray
    place: np.ndarray
    length: np.ndarray
    items: list[np.ndarray]
    ids: list
    shortest: int


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort the same way."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


def build_queries(items: list[tuple], window: int = WINDOW) -> Queries:
    vocabulary: dict[str, int] = {}
    numbers, ids = [], []
    for item_id, text in items:
        own = words(text or "")
        if own:
            numbers.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in own], dtype=np.uint32))
            ids.append(item_id)
    size = np.array([len(own) for own in numbers], dtype=np.int64)
    flat = np.concatenate([*numbers, np.zeros(window, dtype=np.uint32)])
    windows = size - np.minimum(size, window) + 1
    item = np.repeat(np.arange(len(numbers)), windows)
    place = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    length = np.minimum(size, window)[item]
    first = (np.cumsum(size) - size)[item] + place
    rows = flat[first[:, None] + np.arange(window)[None, :]]
    beyond = np.arange(window)[None, :] >= length[:, None]
    rows[beyond] = 0
    short = np.flatnonzero(length < window)
    upper = rows[short]
    upper[beyond[short]] = 0xFFFFFFFF
    return Queries(vocabulary, _keys(rows), short, _keys(upper), item, place, length, numbers, ids,
                   int(length.min()) if len(length) else window)


class Shard:
    """The suffix array of some documents' words."""

    def __init__(self, texts: list[str | None], queries: Queries, window: int = WINDOW):
        number = queries.vocabulary.get
        parts, starts, self.n_words = [], [], []
        at = 0
        for text in texts:
            own = words(text) if text else []
            parts.append(np.fromiter((number(w, 0) for w in own), dtype=np.uint32, count=len(own)))
            starts.append(at)
            self.n_words.append(len(own))
            at += len(own) + 1                     # a 0 ends every document
        self.starts = np.array(starts, dtype=np.int64)
        ids = np.zeros(at + window, dtype=np.uint32)
        for start, part in zip(starts, parts):
            ids[start:start + len(part)] = part
        self.ids = ids
        # known words that follow each position, up to the next 0
        zero = np.flatnonzero(ids == 0)
        known = np.flatnonzero(ids)
        run = zero[np.searchsorted(zero, known)] - known
        long = run >= queries.shortest
        self.suffixes, self.run = known[long], run[long]
        rows = ids[self.suffixes[:, None] + np.arange(window)[None, :]]
        rows[np.arange(window)[None, :] >= self.run[:, None]] = 0
        keys = _keys(rows)
        order = np.argsort(keys, kind="stable")
        self.suffixes, self.keys = self.suffixes[order], keys[order]

    def locations(self, queries: Queries) -> Iterator[tuple[int, np.ndarray]]:
        """For each benchmark suffix that occurs: its number and where."""
        lo = np.searchsorted(self.keys, queries.lower, side="left")
        hi = np.searchsorted(self.keys, queries.lower, side="right")
        hi[queries.short] = np.searchsorted(self.keys, queries.short_upper, side="right")
        for q in np.flatnonzero(hi > lo):
            yield int(q), self.suffixes[lo[q]:hi[q]]

    def matches(self, queries: Queries) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The longest verbatim matches: for each benchmark suffix that begins
        some, its number, where, and how many words.  A match begins where the words
        before differ (or there is none), so each is given once."""
        for q, positions in self.locations(queries):
            place = queries.place[q]
            if place:
                before = queries.items[queries.item[q]][place - 1]
                positions = positions[(positions == 0) | (self.ids[positions - 1] != before)]
            if len(positions):
                yield q, positions, self.longest(queries, q, positions)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def longest(self, queries: Queries, q: int, positions: np.ndarray) -> np.ndarray:
        """Words that match verbatim from each position on."""
        rest = queries.items[queries.item[q]][queries.place[q]:]
        length = np.zeros(len(positions), dtype=np.int64)
        live = np.arange(len(positions))
        for k, word in enumerate(rest):
            at = np.minimum(positions[live] + k, len(self.ids) - 1)
            live = live[self.ids[at] == word]
            if not len(live):
                break
            length[live] += 1
        return length


def _blocks(benchmark: DataFrame) -> list[list[tuple]]:
    """The benchmark in blocks of at most about BLOCK_BYTES of text, one at a
    time on the driver."""
    items = materialize(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "benchmark")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(size) // BLOCK_BYTES
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  carry: list[str] | None = None) -> DataFrame:
    """n_words, n_hit, items (sorted array of item ids as strings) and
    ``matches`` (start and n_words of the longest match from each place where
    one begins, in words) of every row of ``docs``, beside its columns ``carry``
    (doc_id alone by default): ``text`` as itself, the others in a struct ``carried``.
    ``benchmark`` has item_id and text."""
    spark = docs.sparkSession
    carry = carry or ["doc_id"]
    keep = "text" in carry
    carried = F.struct(*[docs[c] for c in carry if c != "text"], F.lit(0).alias("__none"))
    none = F.array().cast("array<int>")
    state = docs.select(carried.alias("carried"), F.col("text").cast("string").alias("text"),
                        F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                        none.alias("starts"), none.alias("lengths"), F.array().cast("array<string>").alias("items"))
    blocks = _blocks(benchmark)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        last = following is None
        shared = share(spark, block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, drop=last and not keep) -> Iterator[pa.RecordBatch]:
            queries = build_queries(shared(), window)
            for whole in batches:
                for batch in sub_batches(whole, "text", SHARD_BYTES):
                    yield _mark(batch, queries, window, drop)

        state = map_batches(state, run, state.schema)
        if not last:
            state = materialize(state, "contamination")
        block = following
    return state.select("carried", *(["text"] if keep else []), "n_words", "n_hit",
                        F.array_sort(F.array_distinct("items")).alias("items"),
                        F.transform(F.arrays_zip("starts", "lengths"), lambda m: F.struct(
                            m["starts"].alias("start"), m["lengths"].alias("n_words"))).alias("matches"))


def _mark(batch: pa.RecordBatch, queries: Queries, window: int, drop_text: bool) -> pa.RecordBatch:
    """Add the longest matches of one benchmark block to a batch of documents,
    and count the words under all that are known so far."""
    shard = Shard(batch.column("text").to_pylist(), queries, window)
    reach = np.zeros(len(shard.ids) + 1, dtype=np.int64)       # words of the longest match from each position
    for d, (old, sizes) in enumerate(zip(batch.column("starts"), batch.column("lengths"))):
        if len(old.values):
            reach[shard.starts[d] + old.values.to_numpy()] = sizes.values.to_numpy()
    found = defaultdict(set)
    for q, positions, length in shard.matches(queries):
        np.maximum.at(reach, positions, length)
        for d in np.unique(shard.document(positions)):
            found[int(d)].add(queries.ids[queries.item[q]])
    begin = np.flatnonzero(reach)
    edge = np.zeros(len(reach) + 1, dtype=np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + reach[begin], -1)
    hit = np.cumsum(np.cumsum(edge) > 0)                       # hit words up to and with each position
    n_hit, starts, lengths, items = [], [], [], []
    for d, old in enumerate(batch.column("items")):
        start, n = int(shard.starts[d]), shard.n_words[d]
        n_hit.append(int(hit[start + n - 1] - (hit[start - 1] if start else 0)) if n else 0)
        own = begin[np.searchsorted(begin, start):np.searchsorted(begin, start + n)]
        starts.append(own - start)
        lengths.append(reach[own])
        items.append(sorted({*old.as_py(), *found.get(d, ())}))
    text = pa.nulls(batch.num_rows, pa.string()) if drop_text else batch.column("text")
    return pa.RecordBatch.from_arrays(
        [batch.column("carried"), text, pa.array(shard.n_words, pa.int64()), pa.array(n_hit, pa.int64()),
         pa.array(starts, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
        names=["carried", "text", "n_words", "n_hit", "starts", "lengths", "items"])


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The locations: item_id, item_word, doc_id, doc_word, n_words -- for
    every occurrence of a window, the longest verbatim match that starts there
    (only where the words before differ, so a match is listed once)."""
    spark = docs.sparkSession
    out = None
    for block in _blocks(benchmark):
        shared = share(spark, block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries = build_queries(shared(), window)
            for whole in batches:
                for batch in sub_batches(whole, "text", SHARD_BYTES):
                    yield from _locate(batch, queries, window)

        part = map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                           "item_id string, item_word int, doc_id long, doc_word int, n_words int")
        out = part if out is None else out.unionByName(part)
    return out


def _locate(batch: pa.RecordBatch, queries: Queries, window: int) -> Iterator[pa.RecordBatch]:
    shard = Shard(batch.column("text").to_pylist(), queries, window)
    ids = batch.column("doc_id").to_pylist()
    for q, positions, length in shard.matches(queries):
        item, place = int(queries.item[q]), int(queries.place[q])
        d = shard.document(positions)
        n = len(positions)
        yield pa.RecordBatch.from_arrays(
            [pa.array([queries.ids[item]] * n, pa.string()), pa.array(np.full(n, place, dtype=np.int32)),
             pa.array([ids[x] for x in d], pa.int64()), pa.array((positions - shard.starts[d]).astype(np.int32)),
             pa.array(length.astype(np.int32))],
            names=["item_id", "item_word", "doc_id", "doc_word", "n_words"])


def contaminated(n_hit, n_words):
    """The contamination rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    found = contamination(docs, benchmark, window, carry=docs.columns)
    return found.where(~contaminated(F.col("n_hit"), F.col("n_words"))).select(
        *[F.col(c) if c == "text" else F.col("carried").getField(c).alias(c) for c in docs.columns])
