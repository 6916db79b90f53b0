"""Exact-substring deduplication by range-partitioned suffixes.

A byte goes if a string of ``SPAN`` bytes that covers it also starts in a
document with a smaller doc_id; strings never cross documents and are judged on
the input, not on what is left.

**Sparse suffixes.**  Every string of 50 bytes has an *anchor*: of the 35
positions from which 16 bytes fit into it, the leftmost with the smallest hash
of these bytes.  Equal strings have equal anchors, so only the suffixes that
start at an anchor (about one byte in 17) are sorted, each carrying the strings
it anchors.

1. *Leading tokens.*  Splitters sampled from a bounded number of documents
   range-partition the suffixes by their first eight bytes; inside a partition
   they are sorted by (a hash of) their leading 16 bytes, with a hash of their
   *surroundings*, the at most 84 bytes of the strings they anchor.  Of equal
   surroundings the smallest doc_id stays and all others are hits as a whole.
   A string of 50 bytes holds, beside its lead, 17 more bytes to the right or
   17 to the left of it; what stays goes on only if other surroundings of the
   lead agree with it on (a short hash of) one of these sides.  Only hashes and
   doc_ids travel here.
2. *Suffixes.*  Those that go on are found again in their texts, and their
   surroundings meet in the same ranges.  A bucket sorts the strings
   of each lead by multikey quicksort, eight bytes at a time, going on only
   inside runs that are still equal; the smallest doc_id of each run of equal
   strings keeps it, all others are hits.  Equal strings share a lead, so no run
   crosses a boundary between partitions, and a bucket is worked off lead by
   lead in bounded memory.
   Equal surroundings inside a document travel once for each part of it (256 KB), with
   their places as stretches of equal steps, so a run of one byte or a repeated
   line costs a few rows whatever its length.
3. *Spans.*  Hits are gathered per document and cut out of its text.

**Hot leads.**  A lead that occurs in many sampled documents (a line that a
third of all documents share) would fill one bucket.  Its strings are dealt out
one by one, by a hash of all their 50 bytes, and each task passes on a string
only if no smaller doc_id has shown it there before (others are hits at once),
so a bucket gets at most about one row per task and string.  The sample decides
on the route only; results are exact on either.

Null texts count as empty.  Rows without a doc_id are smaller than none and stay
whole.  Rows that repeat a doc_id are judged one by one and never against each
other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, share

SPAN, LEAD = 50, 16
REACH = SPAN - LEAD + 1          # places of a lead inside a string
SIDE = REACH // 2                # bytes beside a lead that a string holds on one side at least
HASH_BITS = 32                   # of a lead's hash; the bits above hold its range
MOST_RANGES = 1 << 24            # of leads
BLOCK = 1 << 18                  # bytes worked on at once
SAMPLE_DOCS = 2000               # documents sampled, about, or one in DOCS_A_SAMPLE if that is more
DOCS_A_SAMPLE = 3000             # a lead in more than HOT_DOCS times as many documents is hot, about
SAMPLE_LEADS = 1 << 20           # leads of them that reach the driver, about
HOT_DOCS = 8                     # sampled documents that make a lead hot
MOST_HOT = 1 << 20               # hot leads, the most frequent ones
SEEN_STRINGS = 500_000           # hot strings a task remembers
BUCKET_ROWS = 20_000             # suffixes sorted at once, up to the end of a lead
LEAD_ROWS = 100_000              # rows of leads looked at at once, likewise
TEXT_LEVEL = 6                   # zstd level of texts that travel
BUCKETS_PER_PARTITION = 16

SUFFIX, STRING, HIT, RUN = range(4)    # kinds of rows; RUN: surroundings that are hits as a whole
# place: start in the document << 16 | length of a string or span of hits


def big_endian(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as an integer that sorts alike."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(data), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)


def lead_hashes(eight: np.ndarray) -> np.ndarray:
    """A hash of the LEAD bytes from every position on."""
    x = eight[:-8] * np.uint64(0x9E3779B97F4A7C15)
    x ^= (eight[8:] ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def side_hashes(eight: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Eight bits each of the SIDE bytes right and left of the leads at
    ``lead``; where a document ends sooner no string lies on that side."""
    padded = np.concatenate([np.zeros(SIDE, dtype=np.uint64), eight, np.zeros(LEAD + SIDE, dtype=np.uint64)])
    at, out = lead + SIDE, np.zeros(len(lead), dtype=np.uint64)
    for start in (at + LEAD, at - SIDE):
        x = padded[start] * np.uint64(0x9E3779B97F4A7C15)
        x ^= (padded[start + 8] ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= (padded[start + SIDE - 8] ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out = out << np.uint64(8) | x >> np.uint64(56)
    return out


def surrounding_hashes(eight: np.ndarray, start: np.ndarray, count: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """48 bits of the strings ``count`` from ``start`` on and the place of
    their lead (``shift``)."""
    padded = np.concatenate([eight, np.zeros(SPAN + REACH, dtype=np.uint64)])
    length = count + SPAN - 1
    x = (length << 8 | shift).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, SPAN + REACH - 1, 8):
        spare = np.clip(at + 8 - length, 0, 8)        # bytes of these eight beyond the end
        word = np.where(spare < 8, padded[start + at] >> (np.minimum(spare, 7) * 8).astype(np.uint64), np.uint64(0))
        x = (x ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(29)) >> np.uint64(16)


def anchored_runs(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the concatenated documents ``data`` (``owner``: the document of each
    byte), for every anchor: first string, number of strings, the lead's hash,
    its first eight bytes, and in one number ``surrounding_hashes`` and
    ``side_hashes``."""
    n = len(data) - SPAN + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64), none
    eight = big_endian(data)
    hashes = lead_hashes(eight)
    least, at, size = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while 2 * size <= REACH:
        least, at, size = *_smaller(least, at, size), 2 * size
    if size < REACH:
        least, at = _smaller(least, at, REACH - size)
    strings = np.flatnonzero(owner[:n] == owner[SPAN - 1:SPAN - 1 + n])
    anchor = at[strings].astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    start, lead = strings[first], anchor[first]
    count = np.diff(np.append(first, len(strings)))
    around = surrounding_hashes(eight, start, count, lead - start)
    return start, count, hashes[lead], eight[lead], (around << np.uint64(16) | side_hashes(eight, lead)).view(np.int64)


def _smaller(value: np.ndarray, at: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Elementwise minimum with the array ``shift`` further on; the left one
    of equals."""
    a, b = value[:-shift], value[shift:]
    right = b < a
    return np.where(right, b, a), np.where(right, at[shift:], at[:-shift])


def blocks(documents: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple]]]:
    """Documents (doc_id, bytes) in blocks: the bytes, the part each belongs
    to, and per part (doc_id, checksum, offset in the document, in the block).
    Long documents are cut into parts that overlap by SPAN - 1 bytes."""
    held, parts, size = [], [], 0

    def block() -> tuple:
        lengths = [len(h) for h in held]
        return (np.frombuffer(b"".join(held), dtype=np.uint8),
                np.repeat(np.arange(len(held), dtype=np.int32), lengths), list(parts))

    for doc_id, data in documents:
        mark = zlib.crc32(data)
        for offset in range(0, max(len(data) - SPAN + 1, 0), BLOCK):
            own = data[offset:offset + BLOCK + SPAN - 1]
            held.append(own)
            parts.append((doc_id, mark, offset, size))
            size += len(own)
            if size >= BLOCK:
                yield block()
                held, parts, size = [], [], 0
    if held:
        yield block()


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            if doc_id.is_valid and text.is_valid:
                yield doc_id.as_py(), text.as_buffer().to_pybytes()


def _sample(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Leading bytes of about SAMPLE_LEADS suffixes of sampled documents,
    whatever their length, and hot leads: the hashes of those in HOT_DOCS of
    all these documents, counted in Spark, at most MOST_HOT.  Large tables are
    sampled at a fixed rate, so that a lead that is not hot keeps to a fixed
    number of documents at every size."""
    n, grain = docs.count(), 1 << 30
    kept = grain if n <= SAMPLE_DOCS else max(grain * SAMPLE_DOCS // n, grain // DOCS_A_SAMPLE)
    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, owner, parts in blocks(_documents(batches)):
            start, _, hashes, eight, _ = anchored_runs(data, owner)
            own = np.array([p[0] for p in parts], dtype=np.int64)[owner[start]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(hashes.view(np.int64)), pa.array(eight.view(np.int64))],
                names=["doc_id", "hash", "lead"])

    rows = materialize(map_batches(few, run, "doc_id long, hash long, lead long").distinct(), "suffix-sample")
    total = rows.count()
    some = rows.where(F.pmod(F.xxhash64("doc_id", "hash"), F.lit(grain)) < grain * SAMPLE_LEADS // max(total, SAMPLE_LEADS))
    leads = np.sort(some.select("lead").toPandas()["lead"].to_numpy().astype(np.int64).view(np.uint64))
    hot = (rows.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= HOT_DOCS)
           .orderBy(F.col("times").desc(), "hash").limit(MOST_HOT))
    hashes = np.sort(hot.select("hash").toPandas()["hash"].to_numpy().astype(np.int64).view(np.uint64))
    return leads, hashes


def keys_of(hashes: np.ndarray, lead: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range of a lead's first bytes above, its hash below: one number
    that partitions and sorts suffixes."""
    bucket = np.searchsorted(splitters, lead, side="right").astype(np.uint64)
    return (bucket << np.uint64(HASH_BITS) | hashes >> np.uint64(64 - HASH_BITS)).view(np.int64)


def by_range(rows: DataFrame, parts: int) -> DataFrame:
    """One partition for each group of ranges, sorted by lead."""
    return rows.repartition(parts, F.shiftright("lead", HASH_BITS)).sortWithinPartitions("lead")


def different(*columns: np.ndarray) -> np.ndarray:
    """Rows without those that equal an earlier one in all columns (all but a
    few of them: those that a chance meeting of hashes parts may stay)."""
    mixed = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        mixed = (mixed ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    return np.sort(order[_heads(*(c[order] for c in columns))]) if len(order) else order


ROWS = "lead long, kind tinyint, tail long, doc_id long, mark long, place long"


def _rows(lead, kind, tail, doc_id, mark, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(lead, dtype=np.int64)), pa.array(np.asarray(kind, dtype=np.int8)),
         pa.array(np.asarray(tail, dtype=np.int64)), pa.array(np.asarray(doc_id, dtype=np.int64)),
         pa.array(np.asarray(mark, dtype=np.int64)), pa.array(np.asarray(place, dtype=np.int64))],
        names=["lead", "kind", "tail", "doc_id", "mark", "place"])


def suffixes(docs: DataFrame, splitters: np.ndarray, hot: np.ndarray) -> DataFrame:
    """A row (lead, hashes of surroundings and sides in ``tail``, doc_id) per
    anchored suffix; for the strings of a hot lead a row with their place, or
    the hits found at once."""
    shared, n_buckets = share(docs.sparkSession, (splitters, hot)), len(splitters) + 1

    def spread(number: int) -> int:
        """Any range, for rows that need no company."""
        return number % n_buckets << HASH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        splitters, hot = shared()
        seen: dict[bytes, int] = {}
        for data, owner, parts in blocks(_documents(batches)):
            start, count, hashes, lead, tails = anchored_runs(data, owner)
            if not len(start):
                continue
            doc_id, mark, offset, base = (np.array(x, dtype=np.int64) for x in zip(*parts))
            part = owner[start]
            is_hot = np.isin(hashes, hot)
            own = np.flatnonzero(~is_hot)
            keys, tail, docs_of = keys_of(hashes[own], lead[own], splitters), tails[own], doc_id[part[own]]
            one = different(keys, tail, docs_of)          # a repeated suffix is found again by its key
            none = np.zeros(len(one), dtype=np.int64)
            yield _rows(keys[one], none, tail[one], docs_of[one], none, none)
            out, raw, last = [], data.tobytes(), {}

            def add(mate: tuple, range_key: int, kind: int, tail: int, doc: int, note: int, begin: int, end: int) -> None:
                """A row, or a longer span for its ``mate`` (an equal string,
                or a hit, of the same part) where the two overlap or touch."""
                row = last.get(mate)
                if row is not None and (row[5] >> 16) <= begin <= (row[5] >> 16) + (row[5] & 0xFFFF) \
                        and end - (row[5] >> 16) <= 0xFFFF:
                    row[5] = row[5] >> 16 << 16 | max(row[5] & 0xFFFF, end - (row[5] >> 16))
                    return
                last[mate] = row = [range_key, kind, tail, doc, note, begin << 16 | (end - begin)]
                out.append(row)

            for at in np.flatnonzero(is_hot):
                k, doc, note = int(part[at]), int(doc_id[part[at]]), int(mark[part[at]])
                hit = None                       # the span of hits that goes on
                for begin in range(int(start[at]), int(start[at] + count[at])):
                    digest = xxhash.xxh3_128_digest(raw[begin:begin + SPAN])
                    place = begin - int(base[k]) + int(offset[k])
                    before = seen.get(digest)
                    if before is not None and doc > before:
                        hit = place if hit is None else hit
                        continue
                    if hit is not None:
                        add((k,), spread(place + doc), HIT, 0, doc, note, hit, place + SPAN - 1)
                        hit = None
                    if len(seen) >= SEEN_STRINGS:
                        seen.clear()
                    seen[digest] = doc
                    # 96 of the 128 bits tell strings apart, the others deal them out
                    high = int.from_bytes(digest[:8], "big")
                    add((k, digest), spread(high >> HASH_BITS) | high & (1 << HASH_BITS) - 1, STRING,
                        int.from_bytes(digest[8:], "big", signed=True), doc, note, place, place + SPAN)
                if hit is not None:
                    end = int(start[at] + count[at]) - int(base[k]) + int(offset[k])
                    add((k,), spread(end + doc), HIT, 0, doc, note, hit, end + SPAN - 1)
            if out:
                yield _rows(*zip(*out))

    return map_batches(docs, run, ROWS)


FOUND = "kind tinyint, doc_id long, mark long, value long"


def repeated_leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by lead: suffixes that go on (SUFFIX) and those that
    are hits as a whole (RUN), both with their ``key``; hits (value: place):
    strings of hot leads that a smaller doc_id has, and those found before.
    Whole leads are looked at together; of a lead of more than LEAD_ROWS rows
    every suffix goes on, so that no more than these are held."""
    names = ("lead", "kind", "tail", "doc_id", "mark", "place")
    held, size, long_lead = [], 0, None

    def told(kind: int, doc_id: np.ndarray, mark: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(doc_id), kind, dtype=np.int8)), pa.array(doc_id), pa.array(mark), pa.array(value)],
            names=["kind", "doc_id", "mark", "value"])

    def suffix_rows(kind: int, doc_id: np.ndarray, lead: np.ndarray, tail: np.ndarray) -> pa.RecordBatch:
        return told(kind, doc_id, np.zeros(len(doc_id), dtype=np.int64), key(lead, tail))

    def found(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        lead, kind, tail, doc_id, mark, place = (rows[n] for n in names)
        own = np.flatnonzero(kind == SUFFIX)
        if len(own):
            around = tail[own] >> 16
            own = own[np.lexsort((doc_id[own], around, lead[own]))]
            heads = _heads(lead[own], tail[own] >> 16)
            first = own[heads]                                  # the smallest doc_id of equal surroundings
            least = np.repeat(doc_id[first], np.diff(np.append(heads, len(own))))
            runs = own[doc_id[own] > least]
            if long_lead is not None:
                runs = runs[lead[runs] != long_lead]            # others of it went by before
            yield suffix_rows(RUN, doc_id[runs], lead[runs], tail[runs])
            on = _shared(lead[first], tail[first] >> 8 & 255) | _shared(lead[first], tail[first] & 255)
            first = first[on] if long_lead is None else np.append(first[on & (lead[first] != long_lead)],
                                                                  own[lead[own] == long_lead])
            yield suffix_rows(SUFFIX, doc_id[first], lead[first], tail[first])
        strings = np.flatnonzero(kind == STRING)
        if len(strings):
            strings = strings[np.lexsort((doc_id[strings], tail[strings], lead[strings]))]
            heads = _heads(lead[strings], tail[strings])
            least = np.repeat(doc_id[strings[heads]], np.diff(np.append(heads, len(strings))))
            strings = strings[doc_id[strings] > least]
        hits = np.append(strings, np.flatnonzero(kind == HIT))
        yield told(HIT, doc_id[hits], mark[hits], place[hits])

    def gathered() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {n: table[n].to_numpy() for n in names}

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < LEAD_ROWS:
            continue
        rows = gathered()
        cut = int(np.searchsorted(rows["lead"], rows["lead"][-1]))     # the last lead may go on
        if cut:
            yield from found({n: v[:cut] for n, v in rows.items()})
            held = pa.Table.from_batches(held).slice(cut).to_batches()
            size, long_lead = size - cut, None
        elif (rows["kind"] == SUFFIX).all():
            long_lead = rows["lead"][0]
            yield suffix_rows(SUFFIX, rows["doc_id"], rows["lead"], rows["tail"])
            held, size = [], 0
    if held:
        yield from found(gathered())


def key(lead: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """What finds a suffix again in its document: the 48 bits of its
    surroundings and 16 of its lead."""
    return tail >> 16 << 16 | lead & 0xFFFF


def _heads(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    change = np.ones(len(sorted_columns[0]), dtype=bool)
    change[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return np.flatnonzero(change)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether another row has the same a and b."""
    order = np.lexsort((b, a))
    heads = _heads(a[order], b[order])
    size = np.diff(np.append(heads, len(order)))
    out = np.empty(len(order), dtype=bool)
    out[order] = np.repeat(size > 1, size)
    return out


def equal_strings(data: np.ndarray, start: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the strings of SPAN bytes at ``start``, inside
    their group, by eight bytes at a time; runs of one are left out at once.
    Returns the rows in runs of two or more, and their run."""
    eight = big_endian(data)
    rows, run = np.arange(len(start)), group
    # the outer bytes first: they part strings that only share the lead
    for k in (SPAN - 8, 0, 8, 16, 24, 32, 40):
        value = eight[start[rows] + k]
        order = np.lexsort((value, run))
        rows, run, value = rows[order], run[order], value[order]
        change = np.ones(len(rows), dtype=bool)
        change[1:] = (run[1:] != run[:-1]) | (value[1:] != value[:-1])
        run = np.cumsum(change) - 1
        kept = np.bincount(run, minlength=1)[run] > 1 if len(run) else change
        rows, run = rows[kept], run[kept]
    return rows, run


def bucket_hits(lead: np.ndarray, doc_id: np.ndarray, place: np.ndarray, pieces: pa.Array) -> tuple[np.ndarray, ...]:
    """Of the suffixes of whole leads, with the start of their surroundings
    and these: row, start and length of every span of hits."""
    offsets = np.frombuffer(pieces.buffers()[1], dtype=np.int32)[pieces.offset:pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    begin = (offsets[:-1] - offsets[0]).astype(np.int64)
    count = offsets[1:] - offsets[:-1] - SPAN + 1
    row = np.repeat(np.arange(len(lead)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    group = np.cumsum(np.concatenate([[False], lead[1:] != lead[:-1]]))
    rows, run = equal_strings(data, begin[row] + nth, group[row])
    doc = doc_id[row[rows]]
    order = np.lexsort((doc, run))
    rows, run, doc = rows[order], run[order], doc[order]
    heads = np.flatnonzero(np.diff(run, prepend=-1))
    least = np.repeat(doc[heads], np.diff(np.append(heads, len(run))))
    hits = np.sort(rows[doc > least])
    change = np.ones(len(hits), dtype=bool)
    change[1:] = (hits[1:] != hits[:-1] + 1) | (row[hits[1:]] != row[hits[:-1]])
    first = np.flatnonzero(change)
    length = np.diff(np.append(first, len(hits))) + SPAN - 1
    own = row[hits[first]]
    return own, place[own] + nth[hits[first]], length


def gathered_places(row: np.ndarray, place: np.ndarray, pieces: list[bytes]) -> tuple[list[int], list[bytes | None]]:
    """Of equal pieces of a row the first, and all of their places where they
    are several: (first place, step, number) of each stretch of equal steps."""
    places: dict[tuple[int, bytes], list[int]] = {}
    for at, mate in enumerate(zip(row.tolist(), pieces)):
        places.setdefault(mate, []).append(at)
    again = []
    for own in places.values():
        if len(own) == 1:
            again.append(None)
            continue
        where = place[own]
        step = np.diff(where)
        heads = _heads(step)
        number = np.diff(np.append(heads, len(step))) + 1
        again.append(np.stack([where[heads], step[heads], number], axis=1).astype(np.int64).tobytes())
    return [own[0] for own in places.values()], again


def all_places(again: bytes) -> np.ndarray:
    """The places that ``gathered_places`` wrote (some of them twice)."""
    first, step, number = np.frombuffer(again, dtype=np.int64).reshape(-1, 3).T
    nth = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    return np.repeat(first, number) + np.repeat(step, number) * nth


PIECES = "lead long, doc_id long, mark long, place long, piece binary, again binary"


def surroundings(texts: DataFrame, found: DataFrame, splitters: np.ndarray) -> DataFrame:
    """The strings that each suffix in ``found`` anchors (place: their start),
    cut from its text; spans of hits go along without (place: start << 32 | length)."""
    shared, n_buckets = share(texts.sparkSession, splitters), len(splitters) + 1
    wanted = found.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("kind") == SUFFIX, F.col("value"))).alias("on"),
        F.collect_list(F.when(F.col("kind") == RUN, F.col("value"))).alias("runs"),
        F.collect_list(F.when(F.col("kind") == HIT, F.struct("mark", "value"))).alias("hits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack, splitters = zstandard.ZstdDecompressor(), shared()
        for whole in batches:
            batch = whole.filter(whole.column(3).is_valid())
            doc_ids, marks = np.array(batch.column(0).to_pylist(), dtype=np.int64), batch.column(1).to_numpy()
            begins, ends, rows = [], [], []               # spans of hits
            data = ((k, unpack.decompress(p.as_buffer())) for k, p in enumerate(batch.column(2)))
            for raw, owner, parts in blocks(data):
                start, count, hashes, lead, tails = anchored_runs(raw, owner)
                if not len(start):
                    continue
                row, _, offset, base = (np.array(x, dtype=np.int64) for x in zip(*parts))
                part = owner[start]
                leads = keys_of(hashes, lead, splitters)
                keys = key(leads, tails)
                at = _among(keys, row[part], batch.column(3))
                text = raw.tobytes()
                pieces = [text[a:b] for a, b in zip(start[at].tolist(), (start[at] + count[at] + SPAN - 1).tolist())]
                place = start - base[part] + offset[part]
                own = row[part]
                one, again = gathered_places(own[at], place[at], pieces)
                pieces, at = [pieces[k] for k in one], at[one]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leads[at]), pa.array(doc_ids[own[at]]), pa.array(marks[own[at]]), pa.array(place[at]),
                     pa.array(pieces, pa.binary()), pa.array(again, pa.binary())],
                    names=["lead", "doc_id", "mark", "place", "piece", "again"])
                at = _among(keys, own, batch.column(4))
                begins.append(place[at])
                ends.append(place[at] + count[at] + SPAN - 1)
                rows.append(own[at])
            for k, hits in enumerate(batch.column(5)):
                place = hits.values.field(1).to_numpy()[hits.values.field(0).to_numpy() == marks[k]]
                begins.append(place >> 16)
                ends.append((place >> 16) + (place & 0xFFFF))
                rows.append(np.full(len(place), k, dtype=np.int64))
            if not rows:
                continue
            row, begin, end = _union(*map(np.concatenate, (rows, begins, ends)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((begin + doc_ids[row]) % n_buckets << HASH_BITS), pa.array(doc_ids[row]), pa.array(marks[row]),
                 pa.array(begin << 32 | (end - begin)), pa.nulls(len(row), pa.binary()), pa.nulls(len(row), pa.binary())],
                names=["lead", "doc_id", "mark", "place", "piece", "again"])

    # a left join like the one in `removed`, so that both read one shuffle of the texts
    return map_batches(texts.join(wanted, "doc_id", "left").select("doc_id", "mark", "packed", "on", "runs", "hits"), run, PIECES)


def _among(keys: np.ndarray, row: np.ndarray, wanted: pa.ListArray) -> np.ndarray:
    """The suffixes whose key is in the list of their row."""
    used = np.unique(row).tolist()
    lists = [wanted[k].values.to_numpy() for k in used]
    # key and row as one number (in 64 bits: a chance meeting of the two is as rare as one of two keys)
    salted = np.concatenate([x ^ _salt(np.int64(k)) for k, x in zip(used, lists)])
    return np.flatnonzero(np.isin(keys ^ _salt(row), salted))


def _salt(row):
    with np.errstate(over="ignore"):
        return (row + np.int64(1)) * np.int64(0x1E3779B97F4A7C15)


def _union(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start and end of the maximal runs that spans cover in each row
    (touching ones join)."""
    order = np.lexsort((begin, row))
    row, begin, end = row[order], begin[order], end[order]
    # rows lie apart on one line
    width = int(end.max(initial=0)) + 2
    reach = np.maximum.accumulate(end + row * width)
    first = np.ones(len(row), dtype=bool)
    first[1:] = (begin + row * width)[1:] > reach[:-1]
    heads = np.flatnonzero(first)
    last = np.append(heads[1:], len(row))[:len(heads)] - 1
    return row[heads], begin[heads], reach[last] - row[last] * width


def everywhere(row: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray,
               again: pa.BinaryArray) -> tuple[np.ndarray, ...]:
    """Spans of hits (rows ascending) at all places of their rows; those of a
    row with several places are joined."""
    several = np.flatnonzero(again.is_valid().to_numpy(zero_copy_only=False)[row]) if len(row) else row
    if not len(several):
        return row, start, length
    alone = np.ones(len(row), dtype=bool)
    alone[several] = False
    rows, starts, lengths = [row[alone]], [start[alone]], [length[alone]]
    for k in np.unique(row[several]):
        a, b = np.searchsorted(row, [k, k + 1])
        begin = (all_places(again[int(k)].as_py())[:, None] + (start[a:b] - place[k])).ravel()
        size = np.resize(length[a:b], len(begin))
        _, begin, end = _union(np.zeros(len(begin), dtype=np.int64), begin, begin + size)
        rows.append(np.full(len(begin), k, dtype=np.int64))
        starts.append(begin)
        lengths.append(end - begin)
    return np.concatenate(rows), np.concatenate(starts), np.concatenate(lengths)


SPANS = "doc_id long, mark long, start long, length long"


def sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by lead: the hits, found lead by lead."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        plain = table.filter(pa.compute.is_valid(table["piece"])).combine_chunks()
        known = table.filter(pa.compute.is_null(table["piece"]))
        own = {n: plain[n].to_numpy() for n in ("lead", "doc_id", "mark", "place")}
        row, start, length = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if plain.num_rows:
            row, start, length = bucket_hits(own["lead"], own["doc_id"], own["place"], plain["piece"].chunk(0))
            row, start, length = everywhere(row, start, length, own["place"], plain["again"].chunk(0))
        place = known["place"].to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([own["doc_id"][row], known["doc_id"].to_numpy()])),
             pa.array(np.concatenate([own["mark"][row], known["mark"].to_numpy()])),
             pa.array(np.concatenate([start, place >> 32])),
             pa.array(np.concatenate([length, place & 0xFFFFFFFF]))], names=["doc_id", "mark", "start", "length"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < BUCKET_ROWS:
            continue
        table = pa.Table.from_batches(held)
        lead = table["lead"].to_numpy()
        cut = int(np.searchsorted(lead, lead[-1]))       # the last lead may go on
        held, size = [], len(lead) - cut
        if cut:
            yield spans(table.slice(0, cut))
        held = table.slice(cut).to_batches()
    if held:
        yield spans(pa.Table.from_batches(held))


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, packed (the text's UTF-8 bytes under zstd, as they travel), mark
    (their checksum), spans (array of mark, start, length of hits, which may
    overlap; null if none) of every row of ``docs`` (columns doc_id, text).
    Rows that share a doc_id share the array; a row's own spans bear its mark."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leads, hot = _sample(own)
    ranges = min(BUCKETS_PER_PARTITION * parts, MOST_RANGES)
    cuts = np.linspace(0, len(leads), ranges + 1)[1:-1].astype(int)
    splitters = np.unique(leads[cuts]) if len(leads) else leads

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        packer = zstandard.ZstdCompressor(level=TEXT_LEVEL)
        for batch in batches:
            raw = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                 pa.array([packer.compress(x) for x in raw], pa.binary())], names=["doc_id", "mark", "packed"])

    texts = map_batches(own, pack, "doc_id long, mark long, packed binary")
    found = map_batches(by_range(suffixes(own, splitters, hot), parts), repeated_leads, FOUND)
    spans = map_batches(by_range(surroundings(texts, found, splitters), parts), sorted_buckets, SPANS)
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("mark", "start", "length")).alias("spans"))
    return texts.join(spans, "doc_id", "left").select("doc_id", "mark", "packed", "spans")


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, runs (array of start, end of the maximal removed runs,
    in UTF-8 bytes), kept (the remaining bytes) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, runs, kept = [], [], []
            for mark, packed, spans in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                data = unpack.decompress(packed.as_buffer())
                edges = _merged(spans.values, mark) if spans.is_valid else []
                at, parts = 0, []
                for a, b in edges:
                    parts.append(data[at:a])
                    at = b
                sizes.append(len(data))
                runs.append([{"start": a, "end": b} for a, b in edges])
                kept.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "runs", "kept"])

    return map_batches(removed(docs), run, "doc_id long, n_bytes long, "
                       "runs array<struct<start: bigint, end: bigint>>, kept binary")


def _merged(spans: pa.StructArray, mark: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the spans that bear ``mark``."""
    own = spans.field(0).to_numpy() == mark
    start, length = (spans.field(k).to_numpy()[own] for k in (1, 2))
    _, begin, end = _union(np.zeros(len(start), dtype=np.int64), start, start + length)
    return list(zip(begin.tolist(), end.tolist()))
