"""WARC archives in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle is its frames, a skippable frame with
the record map (record number, frame, offset in the frame's content), and the seek table of the
Zstandard seekable format as its footer. Bundles are rows of a table that Spark writes, so its commit
protocol decides which of several attempts counts, and any store that Spark writes to will do.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Iterator
from itertools import accumulate
from pathlib import Path

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches, small_side, written

#: Content bytes of a frame, and compressed bytes of a bundle, at which the next one begins.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 4 << 20
#: Fixed values of the Zstandard seekable format, and the skippable frame of the record map.
SEEK_TABLE, SEEKABLE, RECORD_MAP = 0x184D2A5E, 0x8F92EAB1, 0x184D2A5D
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 record: a response with the payload, or a revisit that names the response's page."""
    kind = "response" if refers_to is None else "revisit"
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if refers_to is None else b"")
    urn = lambda k: f"<urn:page:{k}>"
    head = {"WARC-Type": kind, "WARC-Record-ID": urn("none" if page_id is None else page_id), "WARC-Date": DATE, "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}", "Content-Type": "application/http;msgtype=response", "Content-Length": len(body), "X-Payload-Length": len(payload)}
    if url is not None:
        head["WARC-Target-URI"] = " ".join(url.split())
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": urn(refers_to)}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + body + b"\r\n\r\n"


def parse_record(content: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """Header fields, payload and the next record's offset, of the record at an offset of a frame's content."""
    split = content.index(b"\r\n\r\n", at)
    first, *lines = content[at:split].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("no record begins here")
    head = dict(x.split(": ", 1) for x in lines)
    to = split + 4 + int(head["Content-Length"])
    return head, content[content.index(b"\r\n\r\n", split + 4) + 4 : to], to + 4


def _skippable(magic: int, data: bytes) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


class Bundler:
    """Gathers records; finish() gives the bundle's bytes."""

    def __init__(self, frame_bytes: int = FRAME_BYTES):
        self.frame_bytes, self.frames, self.sizes, self.map = frame_bytes, [], [], []
        self.open, self.open_size = [], 0
        self.press = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, page_id: int | None, data: bytes) -> int:
        """Compressed bytes so far."""
        self.map.append((page_id, len(self.frames), self.open_size))
        self.open.append(data)
        self.open_size += len(data)
        if self.open_size >= self.frame_bytes:
            self._close()
        return sum(x for x, _ in self.sizes)

    def _close(self) -> None:
        if self.open:
            self.frames.append(self.press.compress(b"".join(self.open)))
            self.sizes.append((len(self.frames[-1]), self.open_size))
            self.open, self.open_size = [], 0

    def finish(self) -> bytes:
        self._close()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + _skippable(RECORD_MAP, json.dumps(self.map).encode()) + _skippable(SEEK_TABLE, table)


class Bundle:
    """Random access to a bundle, from its footer."""

    def __init__(self, data: bytes):
        n, _, magic = struct.unpack("<IBI", data[-9:])
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end")
        table = data[-9 - 8 * n : -9]
        sizes = list(struct.iter_unpack("<II", table))
        self.starts, self.data = [0, *accumulate(x for x, _ in sizes)], data
        magic, length = struct.unpack_from("<II", data, self.starts[-1])
        if magic != RECORD_MAP:
            raise ValueError("no record map after the frames")
        self.map = json.loads(data[self.starts[-1] + 8 : self.starts[-1] + 8 + length])

    def frame(self, k: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.data[self.starts[k] : self.starts[k + 1]])

    def fetch(self, page_id: int) -> tuple[dict, bytes]:
        """The record of a page; only its frame is decompressed."""
        frame, at = next((f, o) for p, f, o in self.map if p == page_id)
        return parse_record(self.frame(frame), at)[:2]


def deduplicated(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): null html is empty; refers_to is the smallest page of the equal payloads, null for that page itself and for payloads below least_bytes."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8").alias("payload")).withColumn("sha1", F.sha1("payload"))
    # payloads are equal if length and two digests are; texts stay where they are if the repeated ones are few
    same = {"n": F.octet_length("payload"), "sha1": F.col("sha1"), "x": F.xxhash64("payload")}
    first = rows.groupBy(*(v.alias(f"of_{k}") for k, v in same.items())).agg(F.min("page_id").alias("first"), F.count("*").alias("times")).where("times > 1 and first is not null").drop("times")
    first = small_side(written(first, "warc-first"))
    joined = rows.join(first, [v == F.col(f"of_{k}") for k, v in same.items()], "left")
    other = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "sha1", F.when(other & (F.octet_length("payload") >= least_bytes), F.col("first")).alias("refers_to"))


def write_bundles(pages: DataFrame, least_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """pages (page_id, url, html) -> (content binary), one row per bundle. Repeated rows each give a record; no pages give no bundle."""
    small_batches(pages.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda b: pa.RecordBatch.from_arrays([pa.array([b.finish()], pa.binary())], ["content"])
        bundle = Bundler(frame_bytes)
        for b in batches:
            for k in range(b.num_rows):
                page_id, url, payload, sha1, refers_to = (c[k].as_py() for c in b.columns)
                if bundle.add(page_id, record(page_id, url, payload, bytes.fromhex(sha1), refers_to)) >= bundle_bytes:
                    yield out(bundle)
                    bundle = Bundler(frame_bytes)
        if bundle.map:
            yield out(bundle)

    return deduplicated(pages, least_bytes).mapInArrow(run, "content binary")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """(content) -> one row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, frame, frame_offset. Payloads of responses are hashed again; one that differs from its header fails the task."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, frame int, frame_offset long"
    number = lambda x: None if x is None or ":none>" in x else int(x[len("<urn:page:") : -1])

    def rows(data: bytes) -> Iterator[tuple]:
        bundle, have, content = Bundle(data), -1, b""
        for page_id, frame, at in bundle.map:
            if frame != have:
                have, content = frame, bundle.frame(frame)
            head, payload, _ = parse_record(content, at)
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            if number(head["WARC-Record-ID"]) != page_id or head["WARC-Type"] == "response" and (len(payload) != int(head["X-Payload-Length"]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                raise ValueError(f"page {page_id} differs from its header")
            yield page_id, int(head["X-Payload-Length"]), digest, head["WARC-Type"], number(head.get("WARC-Refers-To")), frame, at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
        for b in batches:
            for data in b.column(0):
                found = list(zip(*rows(data.as_py()), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")])

    return bundles.select("content").mapInArrow(run, schema)


def export_bundles(bundles: DataFrame, folder: str) -> DataFrame:
    """Copy bundles to files <md5>.warc.zst of a folder that all executors mount -> (path, bytes). Names come from content and files are moved into place, so a task that runs twice does no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                raw = data.as_py()
                path = Path(folder, f"{hashlib.md5(raw).hexdigest()}.warc.zst")
                part = path.with_suffix(".part")
                part.write_bytes(raw)
                part.replace(path)
                yield pa.RecordBatch.from_arrays([pa.array([str(path)]), pa.array([len(raw)], pa.int64())], ["path", "bytes"])

    return bundles.select("content").mapInArrow(run, "path string, bytes long")


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the archives, then read every record back."""
    small_groups = {"parquet.block.size": 16 << 20, "compression": "none"}
    return read_bundles(written(write_bundles(pages, least_bytes), "warc", **small_groups))
