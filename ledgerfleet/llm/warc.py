"""WARC archives: a writer that folds repeated payloads, a splittable reader.

**Reader.**  A file is read as byte ranges, one task row each.  A task scans its
range for the gzip magic, validates every candidate member by decoding its
start (it must inflate and begin with a WARC version line) and owns the records
whose member starts inside the range; the last one may end beyond it.  After an
owned member the scan goes on at its end, so compressed bytes that look like a
magic number are met only where a range begins in mid-member, and fail there.

**Writer.**  One gzip member per record.  Each task writes files of its own with
a unique name and returns a row per file; only files listed in the committed
manifest are ever read, so a task that is lost and repeated leaves at worst an
unlisted file.  Of records with equal payloads of at least ``FOLD_BYTES`` bytes
the one with the largest page_id is a response and the others are revisits that
refer to it; smaller payloads are always stored.

Null payloads are empty.  A null url leaves out the target URI.  Rows that
repeat page_id and payload are written as often as they occur, all of the same
type; a null page_id has the record id of no page and is read back as null.
Empty tables give an empty manifest.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_batches, materialize

FOLD_BYTES = 1000
SPLIT_BYTES = 8 << 20
FILE_BYTES = 1 << 30
MAGIC = b"\x1f\x8b\x08"
READ_BYTES = 1 << 20
PAGE_URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
RECORDS = ("record_type string, record_id string, target_uri string, refers_to string, http_length long, "
           "declared_sha1 string, payload binary")


def typed_pages(pages: DataFrame, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every row of ``pages``
    (page_id, url, html); refers_to is set where the payload is folded."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"))
    own = own.withColumn("digest", F.sha1("payload"))
    groups = (own.where(F.octet_length("payload") >= fold_bytes)
              .groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "kept"))
    # written, so that its size is known before the payloads would be shuffled
    groups = materialize(groups, "warc-groups")
    folded = F.when(F.coalesce(F.col("page_id") != F.col("kept"), F.col("kept").isNotNull()), F.col("kept"))
    return own.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", folded.alias("refers_to"))


def _urn(page_id: int | None) -> str:
    return f"<{PAGE_URN}{'' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                  date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record as a gzip member."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, folder: str | None = None, fold_bytes: int = FOLD_BYTES) -> DataFrame:
    """Write ``pages`` as archives under ``folder`` (a fresh one in the shared
    checkpoint folder by default); the manifest: path, records, bytes."""
    folder = folder or scratch_path(pages.sparkSession, "llm-warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                             else f"file://{folder}")
        store.create_dir(root, recursive=True)
        out, path, records, size = None, None, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "records": records, "bytes": size}],
                                              schema=pa.schema([("path", pa.string()), ("records", pa.int64()),
                                                                ("bytes", pa.int64())]))

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, path, records, size = store.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
                own = encode_record(page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py())
                out.write(own)
                records, size = records + 1, size + len(own)
                if size >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return materialize(map_batches(typed_pages(pages, fold_bytes), run, MANIFEST), "warc-manifest")


class _Window:
    """Bytes of a file from a moving start, read ahead in steps."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def read(self, at: int, n: int) -> bytes:
        return self.file.read_at(min(n, self.size - at), at) if at < self.size else b""


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and where it ends; None if the bytes
    there do not inflate to a WARC record."""
    unpack, parts, pos, first = zlib.decompressobj(31), [], at, True
    try:
        while not unpack.eof:
            data = window.read(pos, 1 << 16)
            if not data:
                return None
            parts.append(unpack.decompress(data))
            pos += len(data)
            if first and sum(map(len, parts)) >= 7:
                if not b"".join(parts).startswith(b"WARC/1."):
                    return None
                first = False
    except zlib.error:
        return None
    return (b"".join(parts), pos - len(unpack.unused_data)) if not first else None


def members(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """The inflated records whose member starts in [start, end)."""
    window, at = _Window(file, size), start
    buffer, base = b"", at
    while at < end:
        if not base <= at < base + max(len(buffer) - 2, 0):
            buffer, base = window.read(at, READ_BYTES), at
        hit = buffer.find(MAGIC, at - base)
        if hit < 0:
            at = base + max(len(buffer) - 2, 1)     # a magic may straddle two reads
            continue
        at = base + hit
        if at >= end:
            return
        found = _member(window, at)
        if found is None:
            at += 1
            continue
        yield found[0]
        at = found[1]


def decode_record(record: bytes) -> dict:
    """The columns of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    block = rest[:int(fields.get("Content-Length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = [int(x[15:]) for x in http.split(b"\r\n") if x[:15].lower() == b"content-length:"]
    digest = fields.get("WARC-Payload-Digest", "")
    revisit = fields.get("WARC-Type") == "revisit"
    return {"record_type": fields.get("WARC-Type"), "record_id": fields.get("WARC-Record-ID"),
            "target_uri": fields.get("WARC-Target-URI"), "refers_to": fields.get("WARC-Refers-To"),
            "http_length": length[0] if length else None,
            "declared_sha1": base64.b32decode(digest[5:]).hex() if digest.startswith("sha1:") else None,
            "payload": None if revisit else payload}


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of ``files`` (path, bytes), read as byte ranges."""
    kind = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                      ("refers_to", pa.string()), ("http_length", pa.int64()), ("declared_sha1", pa.string()),
                      ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for batch in batches:
            for path, size, start in zip(*batch.to_pydict().values()):
                store, local = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:")
                                                      else f"file://{path}")
                with store.open_input_file(local) as file:
                    rows, held = [], 0
                    for record in members(file, size, start, min(start + split_bytes, size)):
                        rows.append(decode_record(record))
                        held += len(record)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=kind)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kind)

    ranges = (files.where("bytes > 0")
              .select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1,
                                                            F.lit(split_bytes).cast("long"))).alias("start")))
    total = files.agg(F.sum("bytes")).first()[0] or 0
    spread = ranges.repartition(max(1, min(100_000, 1 + total // split_bytes)), "path", "start")
    return map_batches(spread, run, RECORDS)


def page_of(urn) -> F.Column:
    """The page_id in a record id of the writer."""
    own = F.regexp_extract(urn, f"^<{PAGE_URN}(-?[0-9]+)>$", 1)
    return F.when(own != "", own.cast("long"))
