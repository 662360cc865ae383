"""WARC archives in seekable Zstandard bundles.

A bundle is one file. Its records stand in groups, each group one Zstandard frame that can be read on
its own; a seek table with the frames' sizes follows as a skippable frame, in the public seekable
format, so any Zstandard reader can also read the file from end to end. The index that writing returns
maps each record to its bundle, frame, offset in the frame and length.

Equal payloads are stored once: the one with the smallest page id is a response record, the others
are revisit records that name it and the payload's digest.

Each task writes its bundles under names of its own into a folder that all executors reach, by any
file system pyarrow knows, and reports them in the index only when they are whole. A task that runs
again writes new files; files that no index row names are to be ignored.

Defined results: a NULL html counts as empty; NULL urls and ids are stored as empty header values. Rows
equal in page id and payload are the same page and get the same record type. Payloads shorter than the
limit are never shared. A payload larger than a frame has a frame of its own. Empty tables give no
bundles. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxlake.sources.scratch import scratch_path, stored

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1

BUNDLES_PER_TASK = 8

INDEX = "page_id long, bundle string, frame int, offset long, length long"
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


@dataclass(frozen=True)
class Bundling:
    frame_bytes: int = 256 << 10
    bundle_bytes: int = 64 << 20  # of records, before compression
    min_shared_bytes: int = 100
    level: int = 3


def _file_system(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for frames of the given compressed and plain sizes."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEK_TABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEK_TABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    entry = 12 if flags & 128 else 8  # with checksums
    file.seek(size - 9 - count * entry)
    body, start, out = file.read(count * entry), 0, []
    for at in range(0, len(body), entry):
        packed, plain = struct.unpack_from("<II", body, at)
        out.append((start, packed, plain))
        start += packed
    return out


def _text(value: object) -> str:
    return "" if value is None else str(value).replace("\r", "%0D").replace("\n", "%0A")


def encode_record(row: dict) -> bytes:
    """One WARC record; a revisit has no block of its own."""
    revisit = row["record_type"] == "revisit"
    block = b"" if revisit else row["payload"]
    name = f"{_text(row['page_id'])}:{row['payload_digest']}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        f"WARC-Target-URI: {_text(row['url'])}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Page-Id: {_text(row['page_id'])}",
        f"X-Payload-Length: {row['payload_bytes']}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-Id: {row['refers_to']}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(frame: bytes, offset: int) -> tuple[dict, int]:
    """The record at an offset, and where the next begins; a payload that fails its digest raises."""
    head_end = frame.index(b"\r\n\r\n", offset)
    lines = frame[offset:head_end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    begin = head_end + 4
    end = begin + int(fields["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    payload = frame[begin:end] if kind == "response" else None
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of page {fields['X-Page-Id']} does not match its digest")
    refers = fields.get("X-Refers-To-Page-Id")
    row = {
        "page_id": int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None,
        "url": fields["WARC-Target-URI"] or None,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": int(refers) if refers is not None else None,
        "payload": payload,
    }
    return row, end + 4


class _Bundle:
    """A bundle being written: records gather in a frame, frames go to the file one by one."""

    def __init__(self, folder: str, settings: Bundling):
        import zstandard

        self.settings, self.packer = settings, zstandard.ZstdCompressor(level=settings.level)
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = _file_system(self.path)
        self.file = system.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple] = []
        self.records: list[bytes] = []
        self.held = self.total = 0

    def add(self, row: dict) -> None:
        record = encode_record(row)
        if self.held and self.held + len(record) > self.settings.frame_bytes:
            self.close_frame()
        self.index.append((row["page_id"], self.path, len(self.frames), self.held, len(record)))
        self.records.append(record)
        self.held += len(record)
        self.total += len(record)

    def close_frame(self) -> None:
        if self.records:
            packed = self.packer.compress(b"".join(self.records))
            self.file.write(packed)
            self.frames.append((len(packed), self.held))
            self.records, self.held = [], 0

    def close(self) -> list[tuple]:
        self.close_frame()
        self.file.write(seek_table(self.frames))
        self.file.close()
        return self.index


def typed_records(pages: DataFrame, settings: Bundling = Bundling(), salts: int = 16) -> DataFrame:
    """Each page with its payload, digest, record type and the page it refers to.

    Only payloads that occur more than once are looked up, on digest and a salt, so pages that share
    one payload are spread over as many tasks.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.cast("binary").alias("payload")).withColumns(
        {
            "payload_bytes": F.length("payload").cast("long"),
            "payload_digest": F.sha2("payload", 256),
        }
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= settings.min_shared_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("_first"), F.count("*").alias("_times"))
        .filter("_times > 1")
        .select("payload_digest", "_first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    )
    salted = rows.withColumn("_salt", F.pmod(F.hash("page_id", "url"), F.lit(salts)))
    revisit = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id"))
    return salted.join(shared, ["payload_digest", "_salt"], "left").select(
        "page_id",
        "url",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_bundles(records: DataFrame, folder: str, settings: Bundling = Bundling()) -> DataFrame:
    """Write records into bundles under ``folder`` and return the stored index of all of them."""
    names = ["page_id", "bundle", "frame", "offset", "length"]
    types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]

    def made(index: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                bundle = bundle or _Bundle(folder, settings)
                bundle.add(row)
                if bundle.total >= settings.bundle_bytes:
                    yield made(bundle.close())
                    bundle = None
        if bundle:
            yield made(bundle.close())

    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    return stored(records.mapInArrow(run, INDEX), "index")


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_RECORD_TYPES = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _frame(file: pa.NativeFile, start: int, packed: int) -> bytes:
    import zstandard

    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(packed))


def read_bundles(bundles: DataFrame, column: str = "bundle") -> DataFrame:
    """All records of the bundles named by a column, frame by frame.

    The number of tasks follows the number of bundles: names are few bytes, and left to themselves
    they would all be put into one task, whatever their archives hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _file_system(uri)
                with system.open_input_file(path) as file:
                    for start, packed, plain in read_seek_table(file):
                        frame, at, out = _frame(file, start, packed), 0, []
                        while at < plain:
                            row, at = decode_record(frame, at)
                            out.append(row)
                        yield _rows(out, _RECORD_TYPES)

    names = bundles.select(F.col(column).alias("bundle")).distinct()
    many = names.count()
    wanted = max(int(bundles.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-many // BUNDLES_PER_TASK))
    return names.repartition(max(1, min(many, wanted))).mapInArrow(run, RECORD)


def fetch(index: DataFrame) -> DataFrame:
    """The records that index rows point to, each read by seeking to its frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _file_system(row["bundle"])
                with system.open_input_file(path) as file:
                    start, packed, _ = read_seek_table(file)[row["frame"]]
                    record, _ = decode_record(_frame(file, start, packed), row["offset"])
                yield _rows([record], _RECORD_TYPES)

    return index.select("page_id", "bundle", "frame", "offset", "length").mapInArrow(run, RECORD)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, settings: Bundling = Bundling()) -> DataFrame:
    """Write all pages and return the index; without a folder, into one that ends with the session."""
    folder = folder or scratch_path(spark, "warc")
    return write_bundles(typed_records(pages, settings), folder, settings)


def summary(records: DataFrame) -> DataFrame:
    columns: list[Column | str] = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.select(*columns)
