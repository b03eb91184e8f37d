"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle (one file) is its frames, a skippable frame with the
record directory, and a footer seek table in the public seekable format. The directory maps a record's identifier to
its frame and to its offset within the frame, so one record costs one frame. Bundles are written by Spark's text
writer, one per file: its task commit makes lost executors harmless, and any file system Spark knows will do. That
writer ends a row with a separator of at least one byte; here that is the last byte of the seek table's magic number.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import class_minimum, ship

#: Numbers and names of the public formats.
SKIPPABLE, SEEK_TABLE, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 32 << 20
DATE = "2024-01-01T00:00:00Z"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_revisit_bytes: int = 0) -> DataFrame:
    """One record per input row: id, url, ``payload`` (null for revisits), ``payload_bytes``, ``payload_sha1`` (hex),
    ``refers_to``.

    Null html is an empty payload. Of equal payloads (SHA-256) of at least ``min_revisit_bytes`` bytes the smallest id
    is the response, the others revisit it; rows that repeat the smallest id are responses too; a null id never beats
    another, and in a group of null ids only all are responses. Only ids and digests are shuffled to find the groups.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha256", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("id", "sha256")
    again = (class_minimum(large, ["sha256"], "id", "first").where("not (id <=> first)")
             .select(F.col("id").alias("_id"), F.col("sha256").alias("_sha"), "first").distinct())
    joined = rows.join(again, rows["id"].eqNullSafe(again["_id"]) & (rows["sha256"] == again["_sha"]), "left")
    return joined.select("id", "url", F.when(F.col("first").isNull(), F.col("payload")).alias("payload"),
                         F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_sha1"),
                         F.col("first").alias("refers_to"))


def record_urn(value) -> str:
    return f"<urn:page:{'' if value is None else value}>"


def pack_record(rid, url, payload, size, sha1, refers_to) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_urn(rid)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_urn(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Header fields (lower-case names), ``block``, and of it ``payload`` and its ``http_length``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    out["block"] = rest[:int(out["content-length"])]
    http, _, out["payload"] = out["block"].partition(b"\r\n\r\n")
    found = re.search(rb"Content-Length: (\d+)", http)
    out["http_length"] = int(found[1]) if found else len(out["payload"])
    return out


class BundleWriter:
    """Groups records into frames and frames into bundles."""

    def __init__(self, frame_bytes: int, bundle_bytes: int):
        import zstandard
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.start()

    def start(self) -> None:
        self.frames, self.sizes, self.directory, self.open, self.raw = [], [], [], bytearray(), 0

    def add(self, urn: str, record: bytes) -> bytes | None:
        """A finished bundle, when this record fills it."""
        self.directory.append(f"{urn}\t{len(self.frames)}\t{len(self.open)}\t{len(record)}")
        self.open += record
        self.raw += len(record)
        if len(self.open) >= self.frame_bytes:
            self.end_frame()
        return self.finish() if self.raw >= self.bundle_bytes else None

    def end_frame(self) -> None:
        if self.open:
            frame = self.compress(bytes(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), len(self.open)))
            self.open = bytearray()

    def finish(self) -> bytes | None:
        self.end_frame()
        if not self.frames:
            return None
        listing = self.compress("\n".join(self.directory).encode())
        self.frames.append(struct.pack("<II", SKIPPABLE, len(listing)) + listing)
        self.sizes.append((len(self.frames[-1]), 0))
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        out = b"".join([*self.frames, struct.pack("<II", SEEK_TABLE, len(entries) + len(footer)), entries, footer])
        self.start()
        return out


class Bundle:
    """A bundle's bytes, read through its seek table."""

    def __init__(self, data: bytes):
        import zstandard
        self.data, self.expand = memoryview(data), zstandard.ZstdDecompressor().decompress
        count, _, magic = struct.unpack("<IBI", self.data[-9:])
        if magic != SEEK_MAGIC:
            raise ValueError("no seek table")
        sizes = list(struct.iter_unpack("<II", self.data[-9 - 8 * count:-9]))
        self.at = [0]
        for packed, _ in sizes:
            self.at.append(self.at[-1] + packed)

    def frame(self, n: int) -> bytes:
        return self.expand(self.data[self.at[n]:self.at[n + 1]])

    def directory(self) -> list[tuple[str, int, int, int]]:
        """(record identifier, frame, offset within the frame, length) of every record."""
        n = len(self.at) - 2
        listing = self.expand(self.data[self.at[n] + 8:self.at[n + 1]]).decode()
        return [(u, int(f), int(o), int(s)) for u, f, o, s in (x.split("\t") for x in listing.split("\n"))]


def write_bundles(recs: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Writes ``records`` rows as bundle files under ``path``, one file per bundle; a task holds one bundle at a time.
    No rows write no bundle."""
    ship(recs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(frame_bytes, bundle_bytes)
        for batch in batches:
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in batch.columns]
                full = writer.add(record_urn(row[0]), pack_record(*row))
                if full:
                    yield pa.RecordBatch.from_arrays([pa.array([full[:-1]], pa.binary())], names=["bundle"])
        full = writer.finish()
        if full:
            yield pa.RecordBatch.from_arrays([pa.array([full[:-1]], pa.binary())], names=["bundle"])

    bundles = recs.select("id", "url", "payload", "payload_bytes", "payload_sha1", "refers_to").mapInArrow(run, "bundle binary")
    last = bytes([SEEK_MAGIC >> 24]).decode("latin-1")
    (bundles.select(F.col("bundle").cast("string")).write.option("encoding", "ISO-8859-1").option("lineSep", last)
     .option("maxRecordsPerFile", 1).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("path", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, path, frame, offset, length) of every record under ``path``, from the bundles' directories."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                urns, frames, offsets, lengths = zip(*Bundle(content.as_buffer()).directory())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(urns), pa.array([file.as_py()] * len(urns)), pa.array(frames, pa.int32()), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64())], names=["record_id", "path", "frame", "offset", "length"])

    return _files(spark, path).mapInArrow(run, "record_id string, path string, frame int, offset bigint, length bigint")


def read_records(spark: SparkSession, path: str, wanted: set[str] | None = None) -> DataFrame:
    """(record_id, record_type, refers_to, url, payload, payload_bytes, payload_digest) of the records under ``path``.

    ``wanted`` (record identifiers) opens only the frames that hold them. ``payload_digest`` of a response is computed
    from the payload read and must equal its header, else the read fails.
    """
    names = ["record_id", "record_type", "refers_to", "url", "payload", "payload_bytes", "payload_digest"]
    kinds = [pa.string()] * 4 + [pa.binary(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                bundle = Bundle(content.as_buffer())
                rows, at, data = [], -1, b""
                for urn, frame, offset, length in bundle.directory():
                    if wanted is not None and urn not in wanted:
                        continue
                    if frame != at:
                        if rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, at, data = [], frame, bundle.frame(frame)
                    rec = parse_record(data[offset:offset + length])
                    digest = rec["warc-payload-digest"].removeprefix("sha1:")
                    if rec["warc-type"] == "response":
                        if base64.b32encode(hashlib.sha1(rec["payload"]).digest()).decode() != digest:
                            raise ValueError(f"{urn}: payload does not match its digest")
                    rows.append((rec["warc-record-id"], rec["warc-type"], rec.get("warc-refers-to"), rec.get("warc-target-uri"),
                                 rec["payload"] if rec["warc-type"] == "response" else None, rec["http_length"], digest))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return _files(spark, path).mapInArrow(
        run, "record_id string, record_type string, refers_to string, url string, payload binary, payload_bytes bigint, payload_digest string")


def page_id(urn: Column) -> Column:
    """The id inside a record identifier, null where it has none."""
    return F.nullif(F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")
