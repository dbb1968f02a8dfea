"""WARC records in seekable Zstandard bundles."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import settle, table

#: Fixed values of the public seekable Zstandard and WARC formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 19
BUNDLE_BYTES = 1 << 30
LEAST_PAYLOAD = 100
DATE = "1970-01-01T00:00:00Z"
INDEX = "record string, bundle string, frame int, offset long, length long"


def record_bytes(record: str, uri: str | None, payload: bytes, digest: str, refers: str | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit with the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers is None else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or "about:blank")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:record:{record}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers is not None:
        lines[2:2] = [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:record:{refers}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC head, HTTP head and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(warc["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


class BundleWriter:
    """Appends records to one file: independent frames, then a skippable frame with the seek table."""

    def __init__(self, store: fs.FileSystem, path: str, frame_bytes: int):
        self.out, self.frame_bytes = store.open_output_stream(path, compression=None), frame_bytes
        self.frame, self.sizes, self.pending, self.written = bytearray(), [], [], 0
        self.zip = zstandard.ZstdCompressor(level=3)

    def add(self, record: str, data: bytes) -> list[tuple[str, int, int, int]]:
        """The (record, frame, offset, length) rows of a frame that this record closes."""
        done = self.flush() if self.frame and len(self.frame) + len(data) > self.frame_bytes else []
        self.pending.append((record, len(self.sizes), len(self.frame), len(data)))
        self.frame += data
        return done

    def flush(self) -> list[tuple[str, int, int, int]]:
        packed = self.zip.compress(bytes(self.frame))
        self.out.write(packed)
        self.written += len(packed)
        self.sizes.append((len(packed), len(self.frame)))
        done, self.pending, self.frame = self.pending, [], bytearray()
        return done

    def close(self) -> list[tuple[str, int, int, int]]:
        done = self.flush() if self.frame else []
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return done


class BundleReader:
    """Reads single frames of a bundle by its seek table; keeps the last frame."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        self.file.seek(size - 9 - 8 * frames)
        table, at = self.file.read(8 * frames), 0
        self.frames = []
        for i in range(frames):
            packed, plain = struct.unpack_from("<II", table, 8 * i)
            self.frames.append((at, packed, plain))
            at += packed
        self.last, self.data = -1, b""

    def read(self, frame: int, offset: int, length: int) -> bytes:
        if frame != self.last:
            at, packed, plain = self.frames[frame]
            self.file.seek(at)
            self.data = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)
            self.last = frame
        return self.data[offset : offset + length]


def write_bundles(rows: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """rows(record, uri, payload, digest, refers): write bundles below folder, return the index (INDEX).

    Each task streams its rows into files of its own, one frame in memory at a time. A task that is tried
    again writes new files; the index, committed by Spark, names only those of the attempt that counted.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        writer, name = None, ""

        def index(done):
            columns = list(zip(*done)) if done else [[]] * 4
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            values = [columns[0], [name] * len(done), *columns[1:]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], names=["record", "bundle", "frame", "offset", "length"]
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("record", "uri", "payload", "digest", "refers"))):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store, f"{root}/{name}", frame_bytes)
                if done := writer.add(row[0], record_bytes(*row)):
                    yield index(done)
                if writer.written >= bundle_bytes:
                    yield index(writer.close())
                    writer = None
        if writer is not None:
            yield index(writer.close())

    return rows.select("record", "uri", "payload", "digest", "refers").mapInArrow(write, INDEX)


def read_bundles(index: DataFrame, folder: str, tasks: int, payloads: bool = True) -> DataFrame:
    """Read the index's records back: record, type, uri, payload_bytes, payload_digest, refers and payload.

    Rows of a frame go to one task, so each frame is read once. The digest of a response is computed anew and
    must equal its head's. A revisit has the length and digest of the payload it stands for, and no payload.
    """
    names = ["record", "type", "uri", "payload_bytes", "payload_digest", "refers", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def name_of(urn: str | None) -> str | None:
        return urn[len("<urn:record:") : -1] if urn else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        bundle, reader = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["bundle"] != bundle:
                    bundle, reader = row["bundle"], BundleReader(store, f"{root}/{row['bundle']}")
                warc, http, payload = parse_record(reader.read(row["frame"], row["offset"], row["length"]))
                digest = warc["WARC-Payload-Digest"].partition(":")[2]
                if warc["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"record {row['record']} of {bundle} is damaged")
                kept = payload if payloads and warc["WARC-Type"] == "response" else None
                out.append((name_of(warc["WARC-Record-ID"]), warc["WARC-Type"], warc["WARC-Target-URI"], int(http["Content-Length"]),
                            digest, name_of(warc.get("WARC-Refers-To")), kept))
                if kept is not None and len(out) >= 100:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names=names)

    dealt = index.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.mapInArrow(
        read, "record string, type string, uri string, payload_bytes long, payload_digest string, refers string, payload binary"
    )


def archive(pages: DataFrame, folder: str, least: int = LEAST_PAYLOAD, **sizes: int) -> DataFrame:
    """pages(page_id, url, html): write every row as a record, return the index, settled.

    Of rows with equal payloads of `least` bytes or more the one with the smallest page_id is a response and the
    others revisit it; rows that share the smallest page_id are all responses, and so is everything where all
    ids are null. A null html is an empty payload, a null url becomes about:blank. Payloads are told apart by
    SHA-256. A group of copies is counted by partial aggregation and joined with its rows, which Spark splits.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    first = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(first.where("n > 1").select("digest", "first"), "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("record"), F.col("url").alias("uri"), "payload", "digest",
        F.when(again, F.col("first").cast("string")).alias("refers"),
    )
    return settle(write_bundles(rows, folder, **sizes), "warc-index")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    index = archive(table(spark, sf_dir, "pages"), folder)
    total = index.agg(F.sum("length")).first()[0] or 0
    records = read_bundles(index, folder, max(12, -(-total // (64 << 20))), payloads=False)
    return records.select(
        F.when(F.col("record") != "null", F.col("record").cast("long")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers").cast("long").alias("refers_to"),
    )


OP2_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
