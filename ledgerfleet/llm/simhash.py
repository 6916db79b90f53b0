"""SimHash near-duplicates linked through vantage-point trees.

A document's fingerprint has 64 bits; bit i is set if it is set in over half
of the XXH64 hashes of the document's word shingles.  Two fingerprints link at
``max_bits`` or fewer differing bits; documents of one connected component are
near-duplicates.

**Partition.**  Distances between whole 64-bit fingerprints crowd around 32,
so a ball of radius 3 would cross most median splits.  The tree is therefore
built over each 32-bit half: fingerprints within 3 bits differ by at most 1 bit
in one of the halves, and a search radius of 1 in a half crosses few
boundaries.  For each half a vantage-point tree (vantage value, median
distance) is fitted on a bounded sample and broadcast; it has at most
``MAX_LEAVES`` leaves.  Every distinct fingerprint goes to its home leaf and,
where the triangle inequality cannot exclude a partner (|d - median| within
the radius), also as a visitor to the leaves beyond the boundary.  Of two
leaves only the later one is visited, so a pair meets once.

**Leaves.**  A leaf is cut into blocks of bounded size (a third of all
fingerprints may be near copies that no tree can part); each block pair goes on
splitting by its own local vantage-point tree and compares what is left
exactly, over all 64 bits.  A block returns no pairs but a spanning star of each
component it sees, so the output stays linear in the rows.

**Components.**  Minimum labels with pointer jumping over the stars, as
DataFrame joins; every round is written to the shared folder.

Exact copies and equal fingerprints are folded before anything else, so the
tree sees distinct fingerprints only.  Null and empty texts have fingerprint
zero and link like any other.  Repeated doc_ids keep one row each; null
doc_ids are returned with the component of their fingerprint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, map_batches, materialize, share

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
LEAF_ROWS = 2048          # rows a leaf of the broadcast tree aims at
MAX_LEAVES = 1 << 17      # bound of the broadcast tree
SAMPLE_PER_LEAF = 16
BLOCK_ROWS = 16384        # rows of one side of a block pair
LOCAL_ROWS = 512          # local trees stop splitting here

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_HASH_CHUNK = 1 << 14


def shingles(text: str, width: int) -> list[str]:
    words = _WORD.findall(ascii_lower(text))
    if len(words) >= width:
        return [" ".join(x) for x in zip(*(words[i:] for i in range(width)))]
    return [" ".join(words)] if words else []


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a whole text as a signed long."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    grams = shingles(text, width) if text else []
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(grams), _HASH_CHUNK):
        part = grams[at:at + _HASH_CHUNK]
        h = np.fromiter((digest(g, SEED) for g in part), dtype=np.uint64, count=len(part))
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(grams)).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, mark: Column | None = None) -> DataFrame:
    """doc_id, mark (a long of the row's own, null by default), fp (signed
    long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), width) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps, pa.int64())],
                                             names=["doc_id", "mark", "fp"])

    mark = F.lit(None) if mark is None else mark
    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                                   mark.cast("long").alias("mark")), run, "doc_id long, mark long, fp long")


def halves(fps: np.ndarray, half: int) -> np.ndarray:
    return ((fps >> np.uint64(32 * (1 - half))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


@dataclass
class VantageTree:
    """Nodes in arrays; ``inside``/``outside`` are node numbers, a leaf has
    its leaf number in ``leaf`` (else -1).  Inside: distance <= median."""
    vantage: list[int] = field(default_factory=list)
    median: list[int] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)
    outside: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def _node(self) -> int:
        for column, value in ((self.vantage, 0), (self.median, 0), (self.inside, -1), (self.outside, -1),
                              (self.leaf, -1)):
            column.append(value)
        return len(self.leaf) - 1

    def route(self, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each leaf: its number, the rows at home there, and all rows
        whose ball of ``radius`` reaches it."""
        everything = np.arange(len(values))
        todo = [(0, everything, everything)]
        while todo:
            node, home, reach = todo.pop()
            if not len(reach):
                continue
            if self.leaf[node] >= 0:
                yield self.leaf[node], home, reach
                continue
            v, mu = np.uint32(self.vantage[node]), self.median[node]
            d = np.bitwise_count(values[reach] ^ v).astype(np.int16)
            h = np.bitwise_count(values[home] ^ v)
            todo.append((self.outside[node], home[h > mu], reach[d + radius > mu]))
            todo.append((self.inside[node], home[h <= mu], reach[d - radius <= mu]))


def split(values: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[int, int] | None:
    """A vantage value and the median distance to it: of a few candidates, the
    one whose boundary band holds the fewest values.  None: nothing parts."""
    best = None
    for v in values[rng.integers(0, len(values), 8)]:
        hist = np.bincount(np.bitwise_count(values ^ v), minlength=33)
        below = np.cumsum(hist)
        mu = int(np.searchsorted(below, len(values) / 2))
        for m in (mu - 1, mu):
            if m < 0 or not 0.2 * len(values) <= below[m] <= 0.8 * len(values):
                continue
            band = int(hist[max(m - radius + 1, 0):m + radius + 1].sum())
            cost = band / len(values) + abs(below[m] / len(values) - 0.5)
            if best is None or cost < best[0]:
                best = (cost, int(v), m)
    return best[1:] if best else None


def fit_tree(sample: np.ndarray, leaf_rows: int, radius: int, seed: int = 7) -> VantageTree:
    """A tree whose leaves hold at most ``leaf_rows`` values of the sample,
    as far as splits can part them."""
    rng, tree = np.random.default_rng(seed), VantageTree()
    todo = [(tree._node(), sample)]
    while todo:
        node, values = todo.pop()
        at = split(values, radius, rng) if len(values) > leaf_rows else None
        if at is None:
            tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
            continue
        tree.vantage[node], tree.median[node] = at
        d = np.bitwise_count(values ^ np.uint32(at[0]))
        tree.outside[node], tree.inside[node] = tree._node(), tree._node()
        todo += [(tree.outside[node], values[d > at[1]]), (tree.inside[node], values[d <= at[1]])]
    return tree


def block_components(fps: np.ndarray, half: int, base: np.ndarray, query: np.ndarray, max_bits: int,
                     radius: int) -> np.ndarray:
    """Component labels (row numbers) of a block pair: rows ``base`` meet rows
    ``query`` (both index arrays).  A local vantage-point tree narrows the rows
    to compare; the comparison is exact over 64 bits."""
    labels = np.arange(len(fps))
    values, rng = halves(fps, half), np.random.default_rng(11)
    todo = [(base, query)]
    while todo:
        b, q = todo.pop()
        if not len(b) or not len(q):
            continue
        at = split(values[b], radius, rng) if len(b) > LOCAL_ROWS else None
        if at is not None:
            v, mu = np.uint32(at[0]), at[1]
            db = np.bitwise_count(values[b] ^ v)
            dq = np.bitwise_count(values[q] ^ v).astype(np.int16)
            todo += [(b[db <= mu], q[dq - radius <= mu]), (b[db > mu], q[dq + radius > mu])]
            continue
        for at in range(0, len(q), 256):
            rows = q[at:at + 256]
            near = np.bitwise_count(fps[rows][:, None] ^ fps[b][None, :]) <= max_bits
            near &= rows[:, None] != b[None, :]
            for k in np.flatnonzero(near.any(axis=1)):
                roots = np.unique(np.append(labels[b[near[k]]], labels[rows[k]]))
                if len(roots) > 1:
                    labels[np.isin(labels, roots)] = roots[0]
    return labels


def _links(distinct: DataFrame, half: int, max_bits: int) -> DataFrame:
    """Stars (u, v) of near fingerprints that agree up to the radius in ``half``."""
    spark, radius = distinct.sparkSession, max_bits // 2
    n = distinct.count()
    leaves = max(1, min(MAX_LEAVES, n // LEAF_ROWS))
    # a bounded sample by hash fits the tree; every fingerprint is indexed
    wanted, grain = leaves * SAMPLE_PER_LEAF * 4, 1 << 30
    kept = grain if n <= wanted else max(1, int(grain * wanted / n))
    sample = distinct.where(F.pmod(F.xxhash64("fp", F.lit(half)), F.lit(grain)) < kept).select("fp").toPandas()
    values = halves(sample["fp"].to_numpy().astype(np.int64).view(np.uint64), half)
    shared = share(spark, fit_tree(values, max(1, len(values) // leaves), radius))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared()
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            home_of = np.full(len(fps), -1, dtype=np.int32)
            reached = list(tree.route(halves(fps, half), radius))
            for leaf, home, _ in reached:
                home_of[home] = leaf
            for leaf, _, reach in reached:
                rows = reach[home_of[reach] <= leaf]      # visit later leaves only
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), leaf, dtype=np.int32)), pa.array(fps[rows].view(np.int64)),
                         pa.array(home_of[rows] == leaf)], names=["leaf", "fp", "home"])

    routed = materialize(map_batches(distinct.select("fp"), route, "leaf int, fp long, home boolean"), "vp-routes")
    # a row per leaf: how many blocks its base and query sides need
    blocks = (routed.groupBy("leaf")
              .agg(F.sum(F.col("home").cast("long")).alias("h"), F.count(F.lit(1)).alias("q"))
              .select("leaf", F.ceil(F.col("h") / BLOCK_ROWS).cast("int").alias("nb"),
                      F.ceil(F.col("q") / BLOCK_ROWS).cast("int").alias("nq"))
              .where("nb > 0"))
    blocks = materialize(blocks, "vp-blocks")
    dealt = (routed.join(blocks, "leaf")
             .withColumn("own_b", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
             .withColumn("own_q", F.pmod(F.xxhash64("fp"), F.col("nq")).cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
             .withColumn("q", F.explode(F.when(F.col("home") & (F.col("b") == F.col("own_b")),
                                               F.sequence(F.lit(0), F.col("nq") - 1))
                                        .otherwise(F.array("own_q"))))
             .select("leaf", "b", "q", "fp", (F.col("home") & (F.col("b") == F.col("own_b"))).alias("base"),
                     (F.col("q") == F.col("own_q")).alias("query")))

    def star(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        labels = block_components(fps, half, np.flatnonzero(table.column("base").to_numpy()),
                                  np.flatnonzero(table.column("query").to_numpy()), max_bits, radius)
        own = np.flatnonzero(labels != np.arange(len(fps)))
        signed = fps.view(np.int64)
        return pa.table({"u": signed[own], "v": signed[labels[own]]})

    return dealt.groupBy("leaf", "b", "q").applyInArrow(star, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): node, root (the smallest node
    reachable).  Minimum labels and pointer jumping, O(log path) rounds; each
    round is written, none is collected."""
    both = materialize(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
                       .distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("u").alias("node"))
                         .agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("root")), "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "root"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near")))
        seen = materialize(labels.join(near, "node")
                           .select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")), "cc-near")
        nxt = materialize(seen.join(labels.select(F.col("node").alias("root"), F.col("root").alias("next")), "root")
                          .select("node", "old", F.least("root", "next").alias("root")), "cc-labels")
        moved = nxt.where(F.col("old") != F.col("root")).limit(1).count()
        labels = nxt.select("node", "root")
        if not moved:
            return labels


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed long), component_id (the smallest doc_id reachable)
    of every row of ``docs`` (columns doc_id, text; others are ignored).
    ``max_bits`` may be 0 to 7: beyond, a half's radius would pass the tree by."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7")
    return _linked(docs, width, max_bits).select("doc_id", "fp", "component_id")


def _linked(docs: DataFrame, width: int, max_bits: int, mark: Column | None = None) -> DataFrame:
    """doc_id, mark, fp, component_id and root (a fingerprint that tells
    components apart, as rows of different ones may share a doc_id)."""
    fps = materialize(fingerprints(docs, width, mark), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fp")
    edges = _links(distinct, 0, max_bits).unionByName(_links(distinct, 1, max_bits))
    roots = components(edges)
    # smallest doc_id of each component, then of each fingerprint
    least = (distinct.join(roots, distinct["fp"] == roots["node"])
             .groupBy("root").agg(F.min("first_id").alias("least")))
    least = materialize(least, "cc-least")
    linked = materialize(roots.join(least, "root").select(F.col("node").alias("fp"), "root", "least"), "cc-linked")
    first = materialize(distinct.join(linked, "fp", "left")
                        .select("fp", F.coalesce("root", "fp").alias("root"),
                                F.coalesce("least", "first_id").alias("component_id")), "cc-first")
    return fps.join(first, "fp").select("doc_id", "mark", "fp", "component_id", "root")


def first_of_each_group(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row
    with the smallest doc_id stays, with all its columns; of different rows of a
    component under that doc_id, the one with the smallest hash.  Rows without a
    doc_id cannot be told apart by it and stay."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be between 0 and 7")
    mark = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns), F.col("text").isNull())
    near = _linked(docs, width, max_bits, mark)
    first = (near.where(F.col("doc_id") == F.col("component_id"))
             .groupBy("root", "doc_id").agg(F.min("mark").alias("mark")))
    first = materialize(first.select(F.col("doc_id").alias("first_id"), F.col("mark").alias("first_mark")), "first-ids")
    own = "near_mark_of_the_row"
    kept = (docs.withColumn(own, mark)
            .join(first, (F.col("doc_id").cast("long") == F.col("first_id")) & (F.col(own) == F.col("first_mark")), "left_semi")
            .dropDuplicates(["doc_id", own]).drop(own))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
