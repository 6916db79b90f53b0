"""Document quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover it whole.
Every byte has a learned embedding; learned filters of eight bytes slide over a
chunk in steps of four.  Each filter is max-pooled over segments of 64 bytes;
the maximum and the mean of these over the chunk (their difference tells
varied text from repeated text) give the chunk's logit.  A document's score is
the logistic of its mean chunk logit.

The network is trained on a bounded sample of labelled documents
(``TRAIN_DOCS``, chosen by a hash of doc_id, at most ``TRAIN_CHUNKS`` evenly
spaced chunks each), so the driver holds a bounded number of bytes whatever the
corpus holds.  Scoring reads every byte of every document in tasks.

Null and empty texts are one chunk of padding and get the score it has.
Without any labelled row every score is 0.5.  Repeated documents are scored one
by one; a repeated label counts as often as it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, share

CHUNK, STEP = 1024, 960       # bytes of a chunk, and from one chunk to the next
BYTE_DIMS, STRIDE, FILTERS = 8, 4, 32
SEGMENT = 64                  # bytes over which a filter is max-pooled first
TRAIN_DOCS, TRAIN_CHUNKS = 6000, 4
TRAIN_STEPS, TRAIN_BATCH = 600, 64
THRESHOLD = 0.3


def chunks(data: bytes) -> np.ndarray:
    """All chunks of a document, zero-padded: (n, CHUNK) bytes."""
    n = 1 if len(data) <= CHUNK else 1 + -(-(len(data) - CHUNK) // STEP)
    padded = np.zeros((n - 1) * STEP + CHUNK, dtype=np.uint8)
    padded[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


@dataclass
class ByteNet:
    """embed (256, BYTE_DIMS); filters (2 * STRIDE * BYTE_DIMS, FILTERS),
    their shift; output weights (2 * FILTERS) and bias."""
    embed: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 3) -> ByteNet:
        rng = np.random.default_rng(seed)
        width = 2 * STRIDE * BYTE_DIMS
        make = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(make(256, BYTE_DIMS, scale=0.5), make(width, FILTERS, scale=width ** -0.5),
                   np.zeros(FILTERS, np.float32), make(2 * FILTERS, scale=0.1), np.zeros(1, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out, self.bias]

    def segments(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of chunks (m, CHUNK): the embedded strides, the filter responses at
        every window, and each filter's activation in each segment (its
        maximum there, rectified) with a mask of segments that hold text."""
        half = STRIDE * BYTE_DIMS
        x = self.embed[block].reshape(len(block), CHUNK // STRIDE, half)
        y = x[:, :-1] @ self.filters[:half]
        y += x[:, 1:] @ self.filters[half:]
        most = np.maximum.reduceat(y, np.arange(0, CHUNK // STRIDE, SEGMENT // STRIDE), axis=1)
        live = block.reshape(len(block), -1, SEGMENT).any(axis=2)
        live[:, 0] = True
        return x, y, np.maximum(most + self.shift, 0) * live[:, :, None], live

    def pooled(self, active: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Maximum and mean over a chunk's segments: (m, 2 * FILTERS)."""
        mean = active.sum(axis=1) / live.sum(axis=1)[:, None]
        return np.concatenate([active.max(axis=1), mean], axis=1).astype(np.float32)

    def logits(self, block: np.ndarray) -> np.ndarray:
        _, _, active, live = self.segments(block)
        return self.pooled(active, live) @ self.out + self.bias[0]

    def gradients(self, block: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over chunks; only the strongest window of
        a filter in a segment passes a gradient back."""
        x, y, active, live = self.segments(block)
        m, parts = live.shape
        features = self.pooled(active, live)
        error = (1 / (1 + np.exp(-(features @ self.out + self.bias[0]))) - label).astype(np.float32) / m
        back = np.broadcast_to((self.out[FILTERS:] / live.sum(axis=1)[:, None])[:, None, :], active.shape).copy()
        top = active.argmax(axis=1)
        rows, cols = np.arange(m)[:, None], np.arange(FILTERS)[None, :]
        back[rows, top, cols] += self.out[:FILTERS]
        back = (back * error[:, None, None] * (active > 0)).astype(np.float32)
        wide = SEGMENT // STRIDE
        tail = np.concatenate([y, np.full((m, 1, FILTERS), -np.inf, np.float32)], axis=1)
        at = tail.reshape(m, parts, wide, FILTERS).argmax(axis=2) + wide * np.arange(parts)[None, :, None]
        d_filters, d_embed = np.empty_like(self.filters), np.zeros_like(self.embed)
        for f in range(FILTERS):                    # windows of one filter: (m, parts, 2 * STRIDE * BYTE_DIMS)
            window = np.concatenate([x[rows, at[:, :, f]], x[rows, at[:, :, f] + 1]], axis=2)
            d_filters[:, f] = back[:, :, f].ravel() @ window.reshape(m * parts, -1)
        some = np.nonzero(back)
        places = at[some][:, None] * STRIDE + np.arange(2 * STRIDE)[None, :]
        used = block[some[0][:, None], places]
        d_window = (back[some][:, None] * self.filters.T[some[2]]).reshape(-1, BYTE_DIMS)
        for k in range(BYTE_DIMS):
            d_embed[:, k] = np.bincount(used.ravel(), weights=d_window[:, k], minlength=256)
        return [d_embed, d_filters, back.sum(axis=(0, 1)), features.T @ error, np.array([error.sum()], np.float32)]


def train(blocks: np.ndarray, labels: np.ndarray, steps: int = TRAIN_STEPS, batch: int = TRAIN_BATCH,
          rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> ByteNet:
    """Adam over random batches of labelled chunks (uint8 rows, 0/1)."""
    net, rng = ByteNet.fresh(), np.random.default_rng(seed)
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        own = rng.integers(0, len(blocks), batch)
        now = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for p, g, m, s in zip(net.parameters(), net.gradients(blocks[own], labels[own]), mean, square):
            g = g + decay * p
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def training_chunks(docs: DataFrame, labels: DataFrame, most_docs: int = TRAIN_DOCS,
                    most_chunks: int = TRAIN_CHUNKS) -> tuple[np.ndarray, np.ndarray]:
    """The bounded sample: evenly spaced chunks and their labels, of at most
    ``most_docs`` rows of ``labels`` (doc_id, label 0/1) and at most ``most_docs``
    times ``most_chunks`` chunks, whatever the number of documents under a labelled
    doc_id: equal rows count once, and of more the smallest by a hash stay."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
              .select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most_docs))
    texts = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values, places, rows = [], [], [], []
            for doc_id, text, label in zip(*batch.to_pydict().values()):
                own = chunks((text or "").encode("utf-8", "replace"))
                for k in np.unique(np.linspace(0, len(own) - 1, most_chunks).round().astype(int)):
                    ids.append(doc_id)
                    values.append(label)
                    places.append(k)
                    rows.append(own[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.int32()), pa.array(places, pa.int32()),
                                              pa.array(rows, pa.binary())], names=["doc_id", "label", "place", "chunk"])

    cuts = map_batches(texts.select(F.col("doc_id").cast("long"), "text", F.col("label").cast("int")), cut,
                       "doc_id long, label int, place int, chunk binary").distinct()
    found = (cuts.orderBy(F.xxhash64("doc_id", "place", "chunk"), "doc_id", "label", "place", "chunk")
             .limit(most_docs * most_chunks).collect())
    found.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["chunk"])))
    data = np.frombuffer(b"".join(bytes(r["chunk"]) for r in found), dtype=np.uint8).reshape(-1, CHUNK)
    return data, np.array([r["label"] for r in found], dtype=np.float32)


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = TRAIN_DOCS, steps: int = TRAIN_STEPS) -> ByteNet | None:
    """Train on ``docs`` (doc_id, text) joined with ``labels`` (doc_id, label);
    None without a labelled document."""
    blocks, values = training_chunks(docs, labels, most_docs)
    return train(blocks, values, steps) if len(blocks) else None


def score(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """doc_id, score of every row of ``docs``, from its text alone."""
    shared = share(docs.sparkSession, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in batches:
            scores = probabilities((t.as_py() or "" for t in batch.column(1)), own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                       "doc_id long, score double")


def good_documents(docs: DataFrame, net: ByteNet | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns."""
    shared = share(docs.sparkSession, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in batches:
            scores = probabilities((t.as_py() or "" for t in batch.column("text")), own)
            yield batch.filter(pa.array([s >= threshold for s in scores], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def probabilities(texts: Iterator[str], net: ByteNet | None, at_once: int = 256) -> list[float]:
    """Scores of whole texts.  Chunks of short documents share a matrix
    product; a long document streams through in blocks."""
    totals, counts, waiting, owner = [], [], [], []

    def flush() -> None:
        if waiting:
            for k, v in zip(owner, net.logits(np.concatenate(waiting))):
                totals[k] += float(v)
            waiting.clear()
            owner.clear()

    for k, text in enumerate(texts):
        own = chunks(text.encode("utf-8", "replace"))
        totals.append(0.0)
        counts.append(len(own))
        if net is None:
            continue
        for start in range(0, len(own), at_once):
            part = own[start:start + at_once]
            waiting.append(part)
            owner.extend([k] * len(part))
            if len(owner) >= at_once:
                flush()
    if net is not None:
        flush()
    mean = np.clip(np.array(totals) / np.array(counts), -60, 60) if totals else np.array([])
    return (1 / (1 + np.exp(-mean))).tolist()


def held_out(doc_id: str | Column, remainder: int = 0, modulus: int = 5) -> Column:
    """Whether a row is kept out of training: crc32 of doc_id as text."""
    own = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(own.cast("string")) % modulus == remainder, F.lit(False))
