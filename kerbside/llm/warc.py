"""WARC archives: writing with revisit records, and a sequential reader.

Every record is a gzip member of its own. The reader takes an archive's bytes in order, inflates
them step by step, frames records by their Content-Length and checks both digests. Archives are
stored as rows (archive, chunk, bytes) of at most CHUNK bytes, so that Spark commits them and any
store that Spark writes to will do; chunks are cut without regard to records. `read_files` reads
.warc.gz files themselves.

Defined cases: a missing payload is empty; equal payloads, empty ones included, are one response
(the largest page_id) and revisits; rows repeated under the responding id are all responses; rows
without an id are responses; an empty table gives archives without records; columns other than
`page_id`, `url` and `html` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import slices, stored

CHUNK = 1 << 20
# Bytes after which a task begins another archive.
ARCHIVE = 64 << 20
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, payload binary")
# FIXED VALUES: the record format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"


def digest(data: bytes) -> str:
    """Base 32 SHA-1, without a label."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    return " ".join(value.split())


def write_record(
    page_id: int | None, url: str | None, payload: bytes, payload_digest: str,
    refers_to: int | None,
) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head only."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Page-ID", "" if page_id is None else f"<{ID_PREFIX}{page_id}>"),
        ("WARC-Target-URI", "" if url is None else _clean(url)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", PROFILE)]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v)
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + \
        deflate.flush()


class SequentialReader:
    """Bytes in, (header fields, block) out, holding at most one record and one chunk."""

    def __init__(self):
        self._inflate = zlib.decompressobj(31)
        self._open = bytearray()  # the record being inflated
        self._begun = False

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        while data:
            self._begun = True
            self._open += self._inflate.decompress(data)
            if not self._inflate.eof:
                return
            data = self._inflate.unused_data
            yield from self._frame()
            self._inflate, self._begun = zlib.decompressobj(31), False

    def close(self) -> None:
        if self._begun:
            raise ValueError("the archive ends inside a record")

    def _frame(self) -> Iterator[tuple[dict[str, str], bytes]]:
        record, self._open = bytes(self._open), bytearray()
        head, gap, rest = record.partition(b"\r\n\r\n")
        version, _, lines = head.partition(b"\r\n")
        if not gap or not version.startswith(b"WARC/"):
            raise ValueError("no WARC header")
        fields = dict(line.split(": ", 1) for line in lines.decode().split("\r\n"))
        size = int(fields["Content-Length"])
        if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"Content-Length {size} does not frame the record")
        yield fields, rest[:size]


def _number(value: str | None) -> int | None:
    return int(value[1 + len(ID_PREFIX) : -1]) if value else None


def parse(fields: dict[str, str], block: bytes) -> tuple:
    """A record's row, after both digests are verified."""
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError("block digest differs")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size, stated = int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest(payload) != stated):
        raise ValueError("payload digest differs")
    return (_number(fields.get("WARC-Page-ID")), fields.get("WARC-Target-URI"), size, stated,
            fields["WARC-Type"], _number(fields.get("WARC-Refers-To")),
            None if revisit else payload)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of a few megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[-1] or b"")
        if size > 2 * CHUNK:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(
            [dict(zip(schema.names, r, strict=True)) for r in held], schema)


_RECORD_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload", pa.binary()),
])
_CHUNK_SCHEMA = pa.schema([("archive", pa.string()), ("chunk", pa.int64()), ("bytes", pa.binary())])


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): null where the record is a response."""
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url",
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    # Only payloads that occur again need a reference.
    groups = stored(
        source.where(F.octet_length("payload") >= min_bytes).groupBy("sha1")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("sha1", "response"), "payload-groups",
    )
    return source.join(groups, "sha1", "left").select(
        "page_id", "url", "payload", "sha1",
        F.when(F.col("page_id") < F.col("response"), F.col("response")).alias("refers_to"),
    )


def write_archives(records: DataFrame) -> DataFrame:
    """(archive, chunk, bytes) of all records; each task fills archives of its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(chunks(batches), _CHUNK_SCHEMA)

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        archive, chunk, size, held = uuid.uuid4().hex, 0, 0, bytearray()
        for batch in slices(batches, "payload"):
            for r in batch.to_pylist():
                stated = base64.b32encode(bytes.fromhex(r["sha1"])).decode()
                held += write_record(r["page_id"], r["url"], r["payload"], stated, r["refers_to"])
                while len(held) >= CHUNK:
                    yield archive, chunk, bytes(held[:CHUNK])
                    del held[:CHUNK]
                    chunk, size = chunk + 1, size + CHUNK
                if size >= ARCHIVE:
                    yield archive, chunk, bytes(held)
                    archive, chunk, size, held = uuid.uuid4().hex, 0, 0, bytearray()
        if held:
            yield archive, chunk, bytes(held)

    return records.mapInArrow(run, "archive string, chunk long, bytes binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of all archives, each read from its first chunk to its last by one task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), _RECORD_SCHEMA)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        archive, due, reader = None, 0, SequentialReader()
        for batch in batches:
            for name, chunk, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                if name.as_py() != archive:
                    reader.close()
                    archive, due, reader = name.as_py(), 0, SequentialReader()
                if chunk.as_py() != due:
                    raise ValueError(f"archive {archive} lacks chunk {due}")
                due += 1
                for fields, block in reader.feed(data.as_py()):
                    yield parse(fields, block)
        reader.close()

    return (
        archives.select("archive", "chunk", "bytes").repartition("archive")
        .sortWithinPartitions("archive", "chunk").mapInArrow(run, RECORDS)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The records of .warc.gz files, one file to a task at a time."""
    files = spark.read.format("binaryFile").load(path)
    return read_archives(files.select(
        F.col("path").alias("archive"), F.lit(0).cast("long").alias("chunk"),
        F.col("content").alias("bytes")))


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    written = stored(write_archives(with_references(pages, min_bytes)), "archives")
    return read_archives(written)
