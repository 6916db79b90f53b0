"""Best-two-fit packing of tokenized documents into sequences.

A document becomes its token ids followed by one end id.  Documents longer
than a sequence are cut into full pieces and a shorter last piece; no other
document is cut.  Only the piece *lengths* decide the packing, and there are
at most ``capacity`` different ones, so the plan is made from a histogram of
lengths whose size is bounded by the capacity whatever the corpus holds:

1. Tasks tokenize whole texts and return one narrow row per piece.
2. ``groupBy(length).count()`` gives the histogram (at most 4096 rows).
3. ``best_two_fit`` packs the histogram: a bin is filled greedily with the
   longest lengths that fit, then its smallest document is replaced by the two
   unpacked documents that fit the widened gap most tightly, if that leaves a
   smaller gap.  A filled bin stands for as many equal bins as the counts
   allow, so the number of steps depends on the capacity, not on the corpus.
4. Pieces are numbered inside their length (a skew-proof ordered scan, since
   a third of all pieces may share one length) and the plan, an array of
   bounded size, turns (length, number) into (sequence, offset).

Null texts count as empty (one piece holding the end id alone).  Repeated rows
are packed as often as they occur.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scan import ordinal
from .common import map_batches, materialize, share, sub_batches

CAPACITY = 4096
END_ID = 1
WORD_TOKENIZER = "word_bpe_49k.json"
# Distinct words a task remembers the ids of; words met later are encoded anew.
MEMO_WORDS = 500_000
ENCODE_BYTES = 6 << 20        # text whose different runs are encoded together

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"

# Texts of these characters only: NFC leaves them as they are, lower-casing
# works character by character, and every word is encoded by itself.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")


class WordEncoder:
    """Token ids of texts as little-endian 32-bit bytes.

    The tokenizer splits a normalized text into words, which hold no white
    space, and encodes each word by itself.  So texts are cut at white space,
    each different run of a batch is encoded once from the remembered ids of
    its words, and the ids of a text are gathered by run number.  A text with a
    character outside the plain set, or with a special-token bracket, goes
    through the tokenizer whole."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        self.memo_words = memo_words
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Words go through the tokenizer as one text; the ids that end a word
        tell where the next begins."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):            # a vocabulary without word ends
            return self._ids(words)
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _run_ids(self, runs: list[str]) -> list[bytes]:
        """The ids of different runs without white space."""
        memo = self.memo
        found = list(map(memo.get, runs))
        open_ = [k for k, ids in enumerate(found) if ids is None]
        parts = list(map(_WORD.findall, map(runs.__getitem__, open_)))
        new = [w for w in set().union(*parts) if w not in memo] if parts else []
        fresh = dict(zip(new, self._word_ids(new))) if new else {}
        if len(memo) < self.memo_words:
            memo.update(fresh)
            get = memo.__getitem__
        else:
            get = {**fresh, **{w: memo[w] for words in parts for w in words if w in memo}}.__getitem__
        for k, words in zip(open_, parts):
            found[k] = get(words[0]) if len(words) == 1 else b"".join(map(get, words))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts."""
        plain = [k for k, t in enumerate(texts) if "<|" not in t and _PLAIN.fullmatch(t)]
        out: list[bytes] = [b""] * len(texts)
        if plain:
            split = pa.compute.ascii_split_whitespace(pa.array([texts[k].lower() for k in plain], pa.large_string()))
            different = split.flatten().dictionary_encode()
            ids = self._run_ids(different.dictionary.to_pylist())
            size = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            run = different.indices.to_numpy()
            own = size[run]
            after = np.cumsum(own)
            # where each run's ids lie in `flat`, spread over its own ids
            shift = (np.cumsum(size) - size)[run] - (after - own)
            data = flat[np.repeat(shift, own) + np.arange(after[-1] if len(after) else 0)].tobytes()
            ends = np.concatenate([[0], after])[split.offsets.to_numpy()]
            for k, a, b in zip(plain, (4 * ends[:-1]).tolist(), (4 * ends[1:]).tolist()):
                out[k] = data[a:b]
        for k in set(range(len(texts))).difference(plain):
            out[k] = self._ids([texts[k]])[0]
        return out


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenized_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                     end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length,
    ids_crc32.  ``tokenizer``: path of the tokenizer file on the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer or tokenizer_path())
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in (part for whole in batches for part in sub_batches(whole, "text", ENCODE_BYTES)):
            rows = []
            encoded = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded):
                ids += end
                n = len(ids) // 4
                for k, start in enumerate(range(0, n, capacity)):
                    cut = ids[4 * start:4 * (start + capacity)]
                    rows.append((doc_id, k, start, len(cut) // 4, zlib.crc32(cut)))
            if rows:
                a, b, c, d, e = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.int64()),
                     pa.array(d, pa.int64()), pa.array(e, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, PIECES)


@dataclass
class Plan:
    """Slots sorted by (length, first number): piece number ``r`` of a length
    lies in the last slot whose ``first`` is at most ``r``; its sequence is
    ``sequence + r - first`` and its place there ``offset``."""
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), dtype=np.int64)
        for value in np.unique(length):
            lo, hi = np.searchsorted(self.length, [value, value + 1])
            own = length == value
            at[own] = lo + np.searchsorted(self.first[lo:hi], number[own], side="right") - 1
        return self.sequence[at] + number - self.first[at], self.offset[at]


def _largest(available: int, most: int) -> int:
    """The largest length of the bit set that is at most ``most``; 0 if none."""
    return (available & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 and available else 0


def _fill(counts: np.ndarray, available: int, capacity: int) -> list[int]:
    """One bin: greedy fill, then the replacement of its smallest document."""
    left = {}
    bin_, gap = [], capacity

    def take(length: int) -> None:
        nonlocal available
        left[length] = left.get(length, int(counts[length])) - 1
        if not left[length]:
            available &= ~(1 << length)

    while (best := max(_largest(available, gap), 0)):
        bin_.append(best)
        gap -= best
        take(best)
    if gap == 0 or len(bin_) < 2:
        return bin_
    smallest = bin_[-1]
    wide, found = gap + smallest, (smallest, 0, 0)
    a = _largest(available, wide - 1)
    while a > 0 and 2 * a > found[0]:
        rest = available & ~(1 << a) if left.get(a, int(counts[a])) < 2 else available
        b = max(_largest(rest, min(a, wide - a)), 0)
        if b and a + b > found[0]:
            found = (a + b, a, b)
            if a + b == wide:
                break
        a = _largest(available, a - 1)
    return bin_ if not found[1] else bin_[:-1] + [found[1], found[2]]


def best_two_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack ``histogram`` (length to count).  Lengths are 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] += n
    available = sum(1 << int(x) for x in np.flatnonzero(counts))
    used = np.zeros(capacity + 1, dtype=np.int64)
    slots, sequence = [], 0
    while available:
        bin_ = _fill(counts, available, capacity)
        uses: dict[int, int] = {}
        for x in bin_:
            uses[x] = uses.get(x, 0) + 1
        times = min(int(counts[x]) // n for x, n in uses.items())
        offset = 0
        for x in bin_:
            slots.append((x, int(used[x]), sequence, offset))
            used[x] += times
            offset += x
        for x, n in uses.items():
            counts[x] -= times * n
            if not counts[x]:
                available &= ~(1 << x)
        sequence += times
    slots.sort()
    cols = np.array(slots, dtype=np.int64).reshape(-1, 4).T
    return Plan(*cols, sequences=sequence)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns doc_id, piece,
    start, length, ids_crc32).  Returns one row per piece."""
    pieces = materialize(pieces, "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in       # at most `capacity` rows
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shared = share(pieces.sparkSession, best_two_fit(histogram, capacity))
    numbered = ordinal(pieces, ["length"], ["doc_id", "piece"], "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared()
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            sequence, offset = plan.place(length, batch.column("number").to_numpy() - 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return map_batches(numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number"), run, PLACED)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                   end_id: int = END_ID) -> DataFrame:
    """Tokenize whole documents and pack them; one row per piece."""
    return pack(tokenized_pieces(docs, tokenizer, capacity, end_id), capacity)
