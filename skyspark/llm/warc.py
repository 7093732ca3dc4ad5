"""WARC archives in seekable Zstandard bundles.

``write_archive`` makes one record for each page: a ``response`` with the payload, or
a ``revisit`` that refers to the response with the same payload. Tasks write bundles:
records are grouped into frames of some FRAME_BYTES, each compressed on its own; a
skippable frame at the end of the file holds the seek table (sizes of all frames, as in
the public seekable format), so that plain Zstandard and WARC readers can read a bundle
through and others can start at any frame. An index maps each record's name to bundle,
frame and the place inside the frame.

``Archive.read`` takes the frames from the seek tables and reads every record;
``Archive.lookup`` opens just the frames that hold the records asked for. Payload digests are
checked on the way; a bundle that disagrees with them is an error.

Bundles lie in a folder that driver and executors share (any that pyarrow can open:
local or mounted paths, hdfs, s3, gs). A task that is run again writes bundles of another name; the
index, committed by Spark, names those that count.

Defined cases: null html is an empty payload; a null url names the page by its number, a
null page_id leaves the number out (such a row is the response of a payload only if all rows
of it lack one); of repeated rows one is the response and the others revisit it; an empty table
gives an archive without records; payloads of any length (below 2 GB) are one record;
characters that a header can't hold are percent-encoded in it; further columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import new_folder
from .common import materialize, release_memory, salted_join, slices

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
#: Frames that one task reads.
TASK_FRAMES = 64
LEVEL = 3
#: Payloads of fewer bytes are never revisited.
MIN_BYTES = 0
#: Tables have no time of capture; records need one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Fixed values of the seekable format: magic numbers, little endian.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1

INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, frame_offset long, frame_bytes long, offset long, length long"
RECORD = "record_id string, record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to_record string, refers_to long, payload binary"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame with (compressed, plain) sizes of all frames."""
    entries = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the end of an open file."""
    size = file.size()
    n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9)) if size >= 17 else (0, 0, 0)
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    width = 12 if flags & 0x80 else 8  # with or without checksums
    start = size - 17 - n * width
    head = struct.unpack("<II", file.read_at(8, start)) if start >= 0 else (0, 0)
    if head != (SKIPPABLE_MAGIC, n * width + 9):
        raise ValueError("the seek table does not fit its bundle")
    table, frames, offset = file.read_at(n * width, start + 8), [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * width)
        frames.append((offset, packed, plain))
        offset += packed
    if offset != start:
        raise ValueError("the frames do not fill their bundle")
    return frames


def _safe(value: str) -> str:
    """A header value: white space and control characters percent-encoded."""
    return "".join(c if c > " " and c not in "\x7f\x85  " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def record_name(uid: int, archive: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(archive), str(uid))}>"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_record(row: dict, archive: str) -> bytes:
    """The response or revisit record of a row: uid, page_id, url, payload, n, digest (base 32), first_uid, first_page."""
    number = None if row["page_id"] is None else str(row["page_id"])
    url = _safe(row["url"]) if row["url"] else f"urn:page:{number or 'none'}"
    revisit = row["first_uid"] is not None
    http = b"" if revisit else f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n']}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_name(row["uid"], archive)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_name(row["first_uid"], archive) if revisit else None),
        ("Page-Refers-To", None if row["first_page"] is None else str(row["first_page"])),
        ("Page-ID", number),
        ("Page-Payload-Length", str(row["n"])),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    return _record(fields, http if revisit else http + row["payload"])


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:stop].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record starts here")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    end = stop + 4 + size
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return headers, data[stop + 4 : end], end + 4


def _fields(headers: dict[str, str], block: bytes) -> tuple | None:
    """The columns of RECORD; None for records that hold no page."""
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    digest, n = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["Page-Payload-Length"])
    payload = None
    if kind == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if sha1_base32(payload) != digest or len(payload) != n:
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    number = lambda k: int(headers[k]) if k in headers else None
    return headers["WARC-Record-ID"], kind, number("Page-ID"), headers["WARC-Target-URI"], n, digest, headers.get("WARC-Refers-To"), number("Page-Refers-To"), payload


class _Bundle:
    """One open bundle; ``add`` and ``close`` give index rows of the frames that they finish."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        system, base = arrow_fs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        system.create_dir(base, recursive=True)
        self.out = system.open_output_stream(f"{base}/{self.name}", compression=None)
        self.packer, self.frame_bytes = zstandard.ZstdCompressor(level=level, write_content_size=True), frame_bytes
        self.frames: list[tuple[int, int]] = []
        self.offset, self.size, self.parts, self.held = 0, 0, [], []
        self.add(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"), None)

    def add(self, record: bytes, row: tuple | None) -> list[tuple]:
        if row is not None:
            self.held.append((row, self.size, len(record)))
        self.parts.append(record)
        self.size += len(record)
        return self._flush() if self.size >= self.frame_bytes else []

    def _flush(self) -> list[tuple]:
        if not self.parts:
            return []
        packed = self.packer.compress(b"".join(self.parts))
        self.out.write(packed)
        done = [(*row, self.name, len(self.frames), self.offset, len(packed), at, length) for row, at, length in self.held]
        self.frames.append((len(packed), self.size))
        self.offset += len(packed)
        self.size, self.parts, self.held = 0, [], []
        return done

    def close(self) -> list[tuple]:
        done = self._flush()
        self.out.write(seek_table(self.frames))
        self.out.close()
        return done


def _table(rows: list[tuple], ddl_types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(ddl_types)], [n for n, _ in ddl_types])


_LONG, _TEXT = pa.int64(), pa.string()
_INDEX = [("record_id", _TEXT), ("page_id", _LONG), ("record_type", _TEXT), ("bundle", _TEXT), ("frame", pa.int32()), ("frame_offset", _LONG), ("frame_bytes", _LONG), ("offset", _LONG), ("length", _LONG)]
_RECORD = [("record_id", _TEXT), ("record_type", _TEXT), ("page_id", _LONG), ("url", _TEXT), ("payload_bytes", _LONG), ("payload_digest", _TEXT), ("refers_to_record", _TEXT), ("refers_to", _LONG), ("payload", pa.binary())]


def write_archive(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL) -> Archive:
    """Write a record for each row of (page_id, url, html); the archive can be read when this returns.

    The pages are written once with their digests, so that a row has one number however
    often tasks run; who revisits whom is decided on narrow rows (a payload's copies are
    dealt to several tasks), and the payloads are shuffled once, evenly by that number.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    archive = str(uuid.uuid5(uuid.NAMESPACE_URL, folder))
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "*", F.octet_length("payload").cast("long").alias("n"), F.unhex(F.sha1("payload")).alias("digest"))
    rows = materialize(rows, "warc-pages", "zstd")
    known = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "uid")
    repeated = rows.filter(F.col("n") >= min_bytes).groupBy("digest").agg(F.min(known).alias("first"), F.count("*").alias("_n"))
    repeated = materialize(repeated.filter("_n > 1"), "warc-copies")
    copies = rows.filter(F.col("n") >= min_bytes).select("uid", "digest")
    revisits = salted_join(copies, repeated.select("digest", "first"), ["digest"], ["uid"], counts=repeated.select("digest", "_n"))
    revisits = revisits.filter(F.col("uid") != F.col("first.uid")).select("uid", F.col("first.uid").alias("first_uid"), F.col("first.page_id").alias("first_page"))
    decided = rows.join(revisits, "uid", "left").withColumn("payload", F.when(F.col("first_uid").isNull(), F.col("payload")))
    bundles = f"{folder}/bundles"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in slices(batches, 200):
            done = []
            for row in batch.to_pylist():
                row["digest"] = base64.b32encode(row["digest"]).decode()
                if bundle is None:
                    bundle = _Bundle(bundles, frame_bytes, level)
                kind = "response" if row["first_uid"] is None else "revisit"
                done += bundle.add(page_record(row, archive), (record_name(row["uid"], archive), row["page_id"], kind))
                if bundle.offset >= bundle_bytes:
                    done += bundle.close()
                    bundle = None
            if done:
                yield _table(done, _INDEX)
        if bundle is not None:
            yield _table(bundle.close(), _INDEX)
        release_memory()

    decided.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return Archive(spark, folder)


def _frame(file, offset: int, size: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(file.read_at(size, offset))


class Archive:
    """A written archive: ``folder``/bundles/*.warc.zst and the index in ``folder``/index."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def index(self) -> DataFrame:
        return self.spark.read.schema(INDEX).parquet(f"{self.folder}/index")

    def frames(self) -> DataFrame:
        """bundle, frame, frame_offset and frame_bytes of all frames, from the seek tables of the bundles that the index names."""
        bundles = f"{self.folder}/bundles"

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, base = arrow_fs.FileSystem.from_uri(bundles)
            for batch in batches:
                for name in batch.column(0).to_pylist():
                    with system.open_input_file(f"{base}/{name}") as file:
                        rows = [(name, i, offset, packed) for i, (offset, packed, _) in enumerate(read_seek_table(file))]
                    yield _table(rows, _INDEX[3:7])

        return self.index().select("bundle").distinct().mapInArrow(scan, "bundle string, frame int, frame_offset long, frame_bytes long")

    def _dealt(self, frames: DataFrame) -> DataFrame:
        """Frames in tasks of some TASK_FRAMES. Their number is stated, as rows that only name frames look like nothing to the engine."""
        n = self.index().select("bundle", "frame").distinct().count()
        return frames.repartition(max(1, -(-n // TASK_FRAMES)), "bundle", "frame")

    def read(self) -> DataFrame:
        """Every record of every bundle (RECORD): frames are dealt to tasks and read from their start to their end."""
        bundles = f"{self.folder}/bundles"

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, base = arrow_fs.FileSystem.from_uri(bundles)
            for batch in batches:
                for row in batch.to_pylist():
                    with system.open_input_file(f"{base}/{row['bundle']}") as file:
                        data = _frame(file, row["frame_offset"], row["frame_bytes"])
                    at, found = 0, []
                    while at < len(data):
                        headers, block, at = parse_record(data, at)
                        found.append(_fields(headers, block))
                    yield _table([r for r in found if r is not None], _RECORD)
            release_memory()

        return self._dealt(self.frames()).mapInArrow(scan, RECORD)

    def lookup(self, ids: DataFrame) -> DataFrame:
        """The records (RECORD) whose ``record_id`` is listed; names that no record has are left out. A frame is opened once for each task that needs it."""
        bundles = f"{self.folder}/bundles"
        places = self.index().join(ids.select("record_id").distinct(), "record_id").select("bundle", "frame", "frame_offset", "frame_bytes", "offset", "length")

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, base = arrow_fs.FileSystem.from_uri(bundles)
            held, data = None, b""
            for batch in slices(batches, 200):
                found = []
                for row in batch.to_pylist():
                    if held != (row["bundle"], row["frame"]):
                        with system.open_input_file(f"{base}/{row['bundle']}") as file:
                            data = _frame(file, row["frame_offset"], row["frame_bytes"])
                        held = row["bundle"], row["frame"]
                    headers, block, end = parse_record(data, row["offset"])
                    if end - row["offset"] != row["length"]:
                        raise ValueError("the index does not fit its bundle")
                    found.append(_fields(headers, block))
                yield _table(found, _RECORD)

        return self._dealt(places).sortWithinPartitions("bundle", "frame", "offset").mapInArrow(fetch, RECORD)

    def payloads(self, ids: DataFrame) -> DataFrame:
        """record_id and payload of the records listed; a revisit has the payload of the response that it refers to."""
        found = self.lookup(ids)
        target = F.coalesce("refers_to_record", "record_id")
        wanted = materialize(found.select("record_id", target.alias("target")), "warc-wanted")
        responses = self.lookup(wanted.select(F.col("target").alias("record_id"))).select(F.col("record_id").alias("target"), "payload")
        return wanted.join(responses, "target").select("record_id", "payload")
