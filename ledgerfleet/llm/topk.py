"""Exact top-k inner products by k-d trees per shard.

Vectors become whole numbers (``floor(scale * x)``).  A hash of the row deals the
candidates into shards of about ``SHARD_ROWS`` rows, one task each.  A task builds a
k-d tree: median splits along the widest dimension, with tight bounding boxes;
queries then stream past it.  For a query the inner product of a box is at most
the sum over dimensions of max(q * low, q * high); the traversal always opens
the box with the highest bound and ends once no bound can beat the k-th score
(of equal scores, the smaller vec_id wins, so a box whose bound equals the k-th
score is opened only if it holds a smaller vec_id).

Every query first meets one shard; its k-th score there goes with it to all
other shards as the score to beat.  The queries are a stated set: they are
copied to each shard, in the rows of one shuffle, so neither side is collected
or broadcast, and a task holds one shard and a batch of queries.

Scores are exact: components are whole float64 numbers, products are made in
float64 while they stay below 2**53, in 64-bit integers below 2**62, and in
unbounded integers beyond; bounds of boxes are widened by what rounding can take
there.  A score beyond a long counts as the largest (or smallest) long.

A row is a candidate of every query but itself, so a repeated row is a
candidate once for each time it stands, also for its own copies, and a repeated query
answers for each of its rows.  Vectors that are null or hold null or non-finite
components, and rows without vec_id, take no part.  Vectors of different lengths never
meet; empty vectors meet each other with score 0.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize

SCALE = 64
SHARD_ROWS = 16384
LEAF_ROWS = 256
SHARD_BYTES = 64 << 20
LONG = (1 << 63) - 1
WIDEST = np.finfo(np.float64).max


def integer_vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """row_id, vec_id, dims, vector (packed little-endian float64) of the rows
    that take part, written once: a row keeps its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for own, values in zip(batch.column(0), batch.column(1)):
                if not own.is_valid or not values.is_valid or values.values.null_count:
                    continue
                x = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        whole = np.clip(np.floor(scale * x), -WIDEST, WIDEST)
                    ids.append(own.as_py())
                    dims.append(len(x))
                    packed.append(whole.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(packed, pa.binary())], names=["vec_id", "dims", "vector"])

    whole = map_batches(table.select(F.col(vec_id).cast("long"), F.col(vector).cast("array<double>")), run,
                        "vec_id long, dims int, vector binary")
    return materialize(whole.withColumn("row_id", F.monotonically_increasing_id()), "topk-points")


def _unpack(packed: pa.Buffer) -> np.ndarray:
    return np.frombuffer(packed, dtype="<f8") if packed.size else np.zeros(0)


@dataclass
class KdTree:
    """Nodes in arrays: bounding boxes, smallest vec_id, and either two
    children or the rows [first, last) of the permuted points."""
    points: np.ndarray
    ids: np.ndarray
    row_ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least_id: np.ndarray
    children: list[tuple[int, int] | None]
    rows: list[tuple[int, int]]

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS,
              row_ids: np.ndarray | None = None) -> KdTree:
        points = points.astype(np.float64)
        order = np.arange(len(points))
        low, high, least, children, rows = [], [], [], [], []

        def node(first: int, last: int) -> int:
            own = points[order[first:last]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            least.append(int(ids[order[first:last]].min()))
            children.append(None)
            rows.append((first, last))
            return len(rows) - 1

        todo = [node(0, len(points))]
        while todo:
            n = todo.pop()
            first, last = rows[n]
            # halves, so that the width of a box never overflows
            wide = high[n] / 2 - low[n] / 2
            if last - first <= leaf_rows or not wide.any():
                continue
            middle = (first + last) // 2
            part = order[first:last]
            order[first:last] = part[np.argpartition(points[part, int(wide.argmax())], middle - first)]
            children[n] = (node(first, middle), node(middle, last))
            todo += children[n]
        return cls(points[order], ids[order], (ids if row_ids is None else row_ids)[order], np.array(low), np.array(high),
                   np.array(least), children, rows)

    def products(self, first: int, last: int, query: np.ndarray) -> np.ndarray:
        """Exact inner products of rows [first, last), within a long."""
        own = self.points[first:last]
        with np.errstate(over="ignore"):
            most = np.abs(own).max(initial=0) * np.abs(query).sum()
        if most < 2 ** 53:
            return (own @ query).astype(np.int64)
        if most < 2 ** 62:
            return own.astype(np.int64) @ query.astype(np.int64)
        q = [int(x) for x in query]
        return np.array([max(-LONG, min(LONG, sum(int(x) * y for x, y in zip(row, q)))) for row in own], dtype=np.int64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """An upper bound of the inner product with every node's box, but for
        rounding (``slack``)."""
        with np.errstate(over="ignore", invalid="ignore"):
            return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def slack(self, query: np.ndarray) -> float:
        """What rounding can take from the bounds of this query."""
        with np.errstate(over="ignore", invalid="ignore"):
            size = float(np.abs(query) @ np.maximum(np.abs(self.low[0]), np.abs(self.high[0])))
        if size < 2 ** 53:
            return 0.0
        return 1 + size * (len(query) + 2) * 2.0 ** -50 if np.isfinite(size) else np.inf

    def best(self, query: np.ndarray, bound: np.ndarray, own_row: int, k: int, floor: int) -> list[tuple[int, int]]:
        """The k best (score, vec_id) but the query's own row; none below
        ``floor``."""
        scores, ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        kth, kth_id = floor, np.iinfo(np.int64).max
        slack, bound = self.slack(query), bound.tolist()
        heap = [(-bound[0], 0)]
        # comparisons are turned so that a bound that is not a number prunes nothing
        while heap:
            top, n = heapq.heappop(heap)
            if -top + slack < kth:
                break
            if -top == kth and not slack and self.least_id[n] >= kth_id:
                continue
            if self.children[n]:
                for c in self.children[n]:
                    if not bound[c] + slack < kth:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            first, last = self.rows[n]
            found = self.products(first, last, query)
            own = np.flatnonzero((found >= kth) & (self.row_ids[first:last] != own_row))
            if not len(own):
                continue
            scores, ids = np.append(scores, found[own]), np.append(ids, self.ids[first + own])
            order = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[order], ids[order]
            if len(scores) == k:
                kth, kth_id = int(scores[-1]), int(ids[-1])
        return list(zip(scores.tolist(), ids.tolist()))


FOUND = "query_id long, query_row long, vec_id long, score long"


def _search(points: DataFrame, queries: DataFrame, shards: int, k: int) -> DataFrame:
    """Queries (shard, row_id, vec_id, dims, vector, floor) against the points
    (shard, row_id, vec_id, dims, vector) of their shard: at most k rows each."""
    rows = (points.select("shard", "dims", F.lit(0).alias("asks"), "vec_id", "row_id", "vector",
                          F.lit(None).cast("long").alias("floor"))
            .unionByName(queries.select("shard", "dims", F.lit(1).alias("asks"), "vec_id", "row_id", "vector", "floor"))
            .repartitionById(shards, "shard").sortWithinPartitions("shard", "dims", "asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree, ids, row_ids, held = None, None, [], [], []
        for batch in batches:
            out = []
            shard, dims, asks, vec_id, row_id, floor = (batch.column(n).to_pylist() for n in (
                "shard", "dims", "asks", "vec_id", "row_id", "floor"))
            vectors = batch.column("vector")
            waiting = []

            def answer(waiting=waiting, out=out) -> None:
                if waiting and tree is not None:
                    q = np.array([v for *_, v in waiting])
                    for (own, row, least, _), x, bound in zip(waiting, q, tree.bounds(q)):
                        out += [(own, row, i, s) for s, i in tree.best(x, bound, row, k, least)]
                waiting.clear()

            for j in range(batch.num_rows):
                if (shard[j], dims[j]) != at:
                    answer()
                    at, tree, ids, row_ids, held = (shard[j], dims[j]), None, [], [], []
                x = _unpack(vectors[j].as_buffer())
                if not asks[j]:
                    ids.append(vec_id[j])
                    row_ids.append(row_id[j])
                    held.append(x)
                    continue
                if tree is None and held:
                    tree = KdTree.build(np.array(ids, dtype=np.int64), np.array(held), LEAF_ROWS,
                                        np.array(row_ids, dtype=np.int64))
                    ids, row_ids, held = [], [], []
                waiting.append((vec_id[j], row_id[j], -LONG if floor[j] is None else floor[j], x))
                if len(waiting) >= 512:
                    answer()
            answer()
            a, b, c, d = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (a, b, c, d)],
                                             names=["query_id", "query_row", "vec_id", "score"])

    return map_batches(rows, run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(points: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, query_row (the row of the query), rank, vec_id, score: the k
    best points of every query but its own row.  ``points`` as ``integer_vectors``
    returns them, ``queries`` some of their rows."""
    size = points.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("vector")), F.lit(0)).alias("b")).first()
    shards = max(1, -(-size["n"] // shard_rows), -(-size["b"] // SHARD_BYTES))
    own = F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int")
    points, asked = points.withColumn("shard", own), queries.withColumn("shard", own)
    first = materialize(_search(points, asked.withColumn("floor", F.lit(None).cast("long")), shards, k), "topk-first")
    kth = _ranked(first, k).where(F.col("rank") == k).select(F.col("query_row").alias("row_id"), F.col("score").alias("floor"))
    others = (asked.join(kth, "row_id", "left").withColumnRenamed("shard", "met")
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> met"))
    found = first.unionByName(_search(points, others, shards, k))
    return _ranked(found, k).select("query_id", "query_row", "rank", "vec_id", "score")
