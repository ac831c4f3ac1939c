"""WARC archives as seekable Zstandard bundles (operator 10).

Records are grouped, ``PER_FRAME`` at a time, into independent Zstandard
frames; a bundle is a run of frames followed by a seek table in a skippable
frame (compressed and uncompressed size of every frame, their number and a
magic number last), so any Zstandard reader can read it from end to end and a
seeking one can jump. For every record the writer returns its identifier with
the bundle, the frame and the offset within the frame.

Of records whose payloads are equal the one with the largest page id is a
``response``, the others are ``revisit`` records that refer to it and carry no
payload. Payloads below ``least`` bytes are never revisited.

A task writes a bundle under a name of its own (with a random part) in the
shared folder and only reports it when it is closed. What a lost task leaves
behind is in no index, so it is never read. Bundles are written through
``pyarrow.fs``, which reaches the stores Spark's cluster shares (file, hdfs,
s3, gs, abfs). Which store a folder is in is settled on the driver, by Spark: a
path without a scheme belongs to the cluster's default file system, and the
executors only ever see whole addresses.

Writing and reading go frame by frame: a task holds the records of one frame.

A null payload is empty. Null ids are written as empty identifiers and come
after all others; rows equal in id and payload get the same kind of record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexicount.llm._spark import Batches, map_arrow, pick, written
from lexicount.sinks import fresh_path

PER_FRAME = 64
FRAME_BYTES = 1 << 20
LEVEL = 3
LEAST = 0
# Fixed values of the seekable format: skippable frame, its magic number.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed values of WARC 1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = "page_id long, bundle string, frame int, at long, size long, begin long, length long"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324 - the format's digest


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has no block."""
    name = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Target-URI: {_header(url)}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha1}", f"X-Payload-Length: {size}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    else:
        head.append("Content-Type: text/html;charset=utf-8")
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def _header(value: str | None) -> str:
    """A header's value on one line."""
    return " ".join((value or "").split())


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    n = int(headers["content-length"])
    if rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return headers, rest[:n]


class BundleWriter:
    """Frames, then the seek table."""

    def __init__(self, out, level: int = LEVEL):
        import zstandard

        self.out, self.zip = out, zstandard.ZstdCompressor(level=level)
        self.at, self.frames, self.waiting, self.size = 0, [], [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        """``(frame, offset within the frame)`` of the record."""
        place = (len(self.frames), self.size)
        self.waiting.append(data)
        self.size += len(data)
        return place

    def full(self, per_frame: int) -> bool:
        return len(self.waiting) >= per_frame or self.size >= FRAME_BYTES

    def flush(self) -> tuple[int, int] | None:
        """Close a frame: ``(place, size)`` in the bundle."""
        if not self.waiting:
            return None
        data = self.zip.compress(b"".join(self.waiting))
        self.out.write(data)
        place = (self.at, len(data))
        self.frames.append((len(data), self.size))
        self.at += len(data)
        self.waiting, self.size = [], 0
        return place

    def close(self) -> None:
        self.flush()
        body = b"".join(struct.pack("<II", c, d) for c, d in self.frames)
        body += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """``(place, compressed size, size)`` of every frame of an open bundle."""
    total = source.size()
    source.seek(total - 9)
    n, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    source.seek(total - 9 - 8 * n)
    at, out = 0, []
    for c, d in struct.iter_unpack("<II", source.read(8 * n)):
        out.append((at, c, d))
        at += c
    if at + 8 + 8 * n + 9 != total:
        raise ValueError("the seek table does not fit the bundle")
    return out


def qualified(spark: SparkSession, folder: str) -> str:
    """The whole address of a folder, as Spark resolves it: by the file it
    makes there for a one-row table."""
    mark = f"made-{uuid.uuid4().hex}"
    path = f"{folder.rstrip('/')}/{mark}"
    spark.range(1).coalesce(1).write.parquet(path)
    (file,) = spark.read.parquet(path).inputFiles()
    return file.rpartition(f"/{mark}/")[0]


def _open(address: str):
    """``(filesystem, path)`` of a whole address."""
    from pyarrow import fs

    scheme, colon, rest = address.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{address!r} does not say which file system it is in")
    if scheme == "file":
        return fs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    if scheme in ("s3a", "s3n"):
        address = f"s3:{rest}"
    return fs.FileSystem.from_uri(address)


def _rows(b: pa.RecordBatch, at_once: int = 64) -> Iterator[dict]:
    """The rows, a few at a time as Python values."""
    for lo in range(0, b.num_rows, at_once):
        yield from b.slice(lo, at_once).to_pylist()


def _write(folder: str, per_frame: int, level: int):
    def run(batches: Batches) -> Batches:
        writer = name = None
        rows: list[tuple] = []

        def closed(place) -> pa.RecordBatch:
            at, size = place
            cols = [[r[0] for r in rows], [name] * len(rows), [r[1] for r in rows], [at] * len(rows), [size] * len(rows), [r[2] for r in rows], [r[3] for r in rows]]
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["page_id", "bundle", "frame", "at", "size", "begin", "length"])
            rows.clear()
            return out

        done = []
        for b in batches:
            for row in _rows(b):
                if writer is None:
                    name = f"{folder.rstrip('/')}/bundle-{uuid.uuid4().hex}.warc.zst"
                    files, path = _open(name)
                    files.create_dir(path.rpartition("/")[0], recursive=True)
                    writer = BundleWriter(files.open_output_stream(path, compression=None), level)
                payload = (row["payload"] or "").encode()
                revisit = row["refers_to"] is not None
                data = record(row["page_id"], row["url"], payload, len(payload), _base32(row["sha1"]), row["refers_to"], revisit)
                frame, begin = writer.add(data)
                rows.append((row["page_id"], frame, begin, len(data)))
                if writer.full(per_frame):
                    done.append(closed(writer.flush()))
        if writer is not None:
            if rows:
                done.append(closed(writer.flush()))
            writer.close()
        # Index rows are handed on after the bundle is whole.
        yield from done

    return run


def _base32(hexed: str) -> str:
    return base64.b32encode(bytes.fromhex(hexed)).decode()


def archived(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST,
    folder: str | None = None, per_frame: int = PER_FRAME, level: int = LEVEL,
) -> DataFrame:
    """Write the bundles, one per task, and return the index: identifier,
    bundle, frame, its place and size, the record's offset in it and length."""
    spark = pages.sparkSession
    src = pick(pages, page_id=page_id, url=url, payload=payload).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("payload").cast("string")
    )
    full = src.withColumn("sha1", F.sha1(F.coalesce("payload", F.lit("")).cast("binary")))
    big = F.octet_length(F.coalesce("payload", F.lit(""))) >= F.lit(least)
    chosen = full.filter(big).groupBy(F.col("sha1").alias("c_sha1")).agg(F.max("page_id").alias("chosen"))
    other = F.when(big & ~F.col("page_id").eqNullSafe(F.col("chosen")), F.col("chosen"))
    marked = full.join(chosen, F.col("sha1") == F.col("c_sha1"), "left").withColumn("refers_to", other)
    target = qualified(spark, folder or fresh_path(spark, "warc"))
    return written(
        map_arrow(marked.select("page_id", "url", "payload", "sha1", "refers_to"), _write(target, per_frame, level), _INDEX),
        "warc-index",
    )


def read_records(files, path: str, wanted: list[dict]) -> Iterator[tuple[dict, dict[str, str], bytes]]:
    """The wanted records (index rows) of one bundle, in the order of their
    places: the seek table gives the place of each frame by its number; the
    frame is fetched and decompressed once, when its first record is asked for,
    and given up before the next."""
    import zstandard

    unzip = zstandard.ZstdDecompressor()
    with files.open_input_file(path) as source:
        table = seek_table(source)
        frame, data = None, b""
        for row in sorted(wanted, key=lambda r: (r["frame"], r["begin"])):
            if row["frame"] != frame:
                frame = row["frame"]
                if not 0 <= frame < len(table):
                    raise ValueError(f"{path}: no frame {frame} in the seek table")
                at, packed, size = table[frame]
                source.seek(at)
                data = unzip.decompress(source.read(packed))
                if len(data) != size:
                    raise ValueError(f"{path}: frame {frame} has {len(data)} bytes, the seek table says {size}")
            headers, block = parse(data[row["begin"] : row["begin"] + row["length"]])
            yield row, headers, block


def _read(batches: Batches) -> Batches:
    for b in batches:
        by_bundle: dict[str, list[dict]] = {}
        for row in b.to_pylist():
            by_bundle.setdefault(row["bundle"], []).append(row)
        rows = []
        for name, wanted in by_bundle.items():
            files, path = _open(name)
            for row, headers, block in read_records(files, path, wanted):
                sha1 = headers["warc-payload-digest"].removeprefix("sha1:")
                kind = headers["warc-type"]
                if kind == "response" and digest(block) != sha1:
                    raise ValueError(f"{name}: the payload of {headers['warc-record-id']} is damaged")
                ref = headers.get("warc-refers-to")
                size = len(block) if kind == "response" else int(headers["x-payload-length"])
                rows.append((_id(headers["warc-record-id"]), size, sha1, kind, _id(ref) if ref else None))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def _id(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name else None


def read_back(index: DataFrame) -> DataFrame:
    """Every indexed record, read from its frame."""
    return map_arrow(index, _read, _READ)
