"""Web archives in seekable Zstandard bundles.

Records are grouped into independent frames; a bundle ends in a skippable frame that lists the sizes of
all frames, so any frame can be read on its own.  The index maps each record id to its bundle, frame and
offset within the frame.  Tasks write bundles under names of their own into the shared folder, and only
the index, which Spark commits, says which bundles count: a lost or repeated task leaves no trace in it.

Of records with equal payloads of at least ``least_bytes`` the one with the largest id holds the payload
(response); the others refer to it (revisit).

Defined results
    null or empty html: a response with an empty payload.  A null id is written and read back as null.
    ties: rows that repeat the largest id of their payload are all responses.
    a null url is written as an empty target; control characters in a url are percent-encoded.
    empty table: an archive without bundles.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
LEAST_BYTES = 1000
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PREFIX = "<urn:meanline:page:"


class Record(NamedTuple):
    page_id: int | None
    kind: str
    refers_to: int | None
    digest: str
    payload_bytes: int
    payload: bytes | None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which leaves the payload out."""
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    fields = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_PREFIX}{'' if page_id is None else page_id}>", f"WARC-Target-URI: {target}",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        fields += [
            f"WARC-Refers-To: {_PREFIX}{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)


def parse_record(data: bytes, offset: int = 0) -> tuple[Record, int]:
    """The record at ``offset`` and where the next one begins; a response's digest is that of its payload."""
    end = data.index(b"\r\n\r\n", offset)
    fields = _fields(data[offset:end])
    block = data[end + 4 : end + 4 + int(fields["Content-Length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(v) if (v := fields[name][len(_PREFIX) : -1]) else None
    kind = fields["WARC-Type"]
    held = payload if kind == "response" else None
    record = Record(
        number("WARC-Record-ID"), kind, number("WARC-Refers-To") if kind == "revisit" else None,
        hashlib.sha1(payload).hexdigest() if held is not None else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        int(_fields(head)["Content-Length"]), held,
    )
    return record, end + 4 + len(block) + 4


class BundleWriter:
    """Writes one bundle: frames one after the other, then the seek table."""

    def __init__(self, file) -> None:
        self._file, self._frames, self._held, self._size = file, [], [], 0
        self._compressor = zstandard.ZstdCompressor(level=6)
        self.bytes = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """The record's frame and offset within it."""
        if self._held and self._size + len(record) > FRAME_BYTES:
            self._close_frame()
        place = len(self._frames), self._size
        self._held.append(record)
        self._size += len(record)
        return place

    def _close_frame(self) -> None:
        if self._held:
            packed = self._compressor.compress(b"".join(self._held))
            self._file.write(packed)
            self._frames.append((len(packed), self._size))
            self.bytes += len(packed)
            self._held, self._size = [], 0

    def close(self) -> None:
        self._close_frame()
        table = b"".join(struct.pack("<II", *frame) for frame in self._frames)
        table += struct.pack("<IBI", len(self._frames), 0, _SEEKABLE)
        self._file.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self._file.close()


class BundleReader:
    """Reads single frames of a bundle."""

    def __init__(self, file) -> None:
        self._file = file
        size = file.size()
        file.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != _SEEKABLE:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * frames)
        self.frames, at = [], 0
        for packed, raw in struct.iter_unpack("<II", file.read(8 * frames)):
            self.frames.append((at, packed, raw))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, raw = self.frames[number]
        self._file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self._file.read(packed), max_output_size=raw)


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def write_archive(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the rows of ``pages`` (page_id, url, html) below ``folder``; returns the index, stored there too."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"size": F.length("payload").cast("bigint"), "digest": F.sha1("payload")}
    )
    holders = (
        known.where(F.col("size") >= least_bytes).groupBy("digest", "size")
        .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    rows = known.join(holders, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(f"{base}/bundles", recursive=True)
        writer, name = None, None
        for batch in batches:
            ids, places, names = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))
            for page_id, url, data, digest, refers_to in zip(*columns, strict=True):
                if writer is None:
                    name = f"bundles/{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(store.open_output_stream(f"{base}/{name}", compression=None))
                places.append(writer.add(record_bytes(page_id, url, data, digest, refers_to)))
                ids.append(page_id)
                names.append(name)
                if writer.bytes >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array([f for f, _ in places], pa.int32()),
                 pa.array([o for _, o in places], pa.int32())],
                names=["page_id", "bundle", "frame", "offset"],
            )
        if writer is not None:
            writer.close()

    index = rows.withColumn("page_id", F.col("page_id").cast("bigint")).withColumn(
        "refers_to", F.col("refers_to").cast("bigint")
    ).mapInArrow(write, "page_id bigint, bundle string, frame int, offset int")
    index.write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, bundle, frame and offset of every record of an archive."""
    return spark.read.schema("page_id bigint, bundle string, frame int, offset int").parquet(f"{folder}/index")


_READ_SCHEMA = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _read(places: DataFrame, folder: str, whole_frames: bool, with_payload: bool) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ExitStack() as opened:
            yield from records(batches, opened)

    def records(batches: Iterator[pa.RecordBatch], opened: ExitStack) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        name, reader, number, frame = None, None, None, b""
        for batch in batches:
            out: list[Record] = []
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    name, number = row["bundle"], None
                    opened.close()  # the bundle before
                    reader = BundleReader(opened.enter_context(store.open_input_file(f"{base}/{name}")))
                if row["frame"] != number:
                    number = row["frame"]
                    frame = reader.frame(number)
                at = 0 if whole_frames else row["offset"]
                while at < len(frame):
                    record, at = parse_record(frame, at)
                    out.append(record)
                    if not whole_frames:
                        break
                if len(out) >= 1000 or with_payload and out:
                    yield _batch(out, with_payload)
                    out = []
            if out:
                yield _batch(out, with_payload)

    return places.mapInArrow(read, _READ_SCHEMA + (", payload binary" if with_payload else ""))


def _batch(records: list[Record], with_payload: bool) -> pa.RecordBatch:
    columns = [
        pa.array([r.page_id for r in records], pa.int64()), pa.array([r.payload_bytes for r in records], pa.int64()),
        pa.array([r.digest for r in records]), pa.array([r.kind for r in records]),
        pa.array([r.refers_to for r in records], pa.int64()),
    ]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    if with_payload:
        columns.append(pa.array([r.payload for r in records], pa.binary()))
        names.append("payload")
    return pa.RecordBatch.from_arrays(columns, names=names)


#: Frames that one task reads, about: their rows are small, so their number and not their bytes has to be dealt out.
TASK_FRAMES = 64


def _by_frame(places: DataFrame, *order: str) -> DataFrame:
    """Places dealt to tasks by frame, as many tasks as the frames need."""
    frames = places.select("bundle", "frame").distinct().count()
    dealt = places.repartition(max(1, -(-frames // TASK_FRAMES)), "bundle", "frame")
    return dealt.sortWithinPartitions("bundle", "frame", *order)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of an archive, frame by frame."""
    return _read(_by_frame(read_index(spark, folder).select("bundle", "frame").distinct()), folder, True, False)


def fetch(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    """The records of the ids in ``ids`` (page_id), payloads included; only the frames that hold them are read."""
    places = read_index(spark, folder).join(ids.select("page_id").distinct(), "page_id", "left_semi")
    return _read(_by_frame(places, "offset"), folder, False, True)
