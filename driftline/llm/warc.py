"""WARC archives: one gzip member per record, written with Spark's text sink and read back by byte ranges.

Writing: records are packed to gzip members inside tasks and handed to the text writer as raw bytes, so that archives
land through Spark's own commit protocol on any file system it can write.  The writer needs a separator between rows; it
is an empty gzip member, which every gzip reader passes over.

Reading: files are cut to byte ranges.  A task looks for the gzip magic in its range, accepts a candidate when the bytes
there inflate to a WARC header, and owns the records that start inside its range, reading past its end if need be.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = b"\x1f\x8b\x08"
SEPARATOR = gzip.compress(b"", mtime=0)
BLOB_BYTES = 4_000_000
RANGE_BYTES = 16_000_000
READ_BYTES = 1_000_000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_NAMESPACE = uuid.UUID("5b0ce9a0-3c1f-5e0f-9a53-2f1f0a6d7c11")

RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page}/{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, response: int | None, is_response: bool, level: int) -> bytes:
    """One WARC record as a gzip member; ``response`` is the page that a revisit refers to."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if is_response else 'revisit'}", f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        # Printable characters stay; others (line ends above all) are escaped.
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if is_response:
        block = _HTTP % len(payload) + payload
        head.append("Content-Type: application/http; msgtype=response")
    else:
        block = b""
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(response, digest)}", f"X-Refers-To-Page: {response}"]
    head += [f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", level, mtime=0)


def write_warc(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", level: int = 6
) -> None:
    """Write a record for every row to archives under ``path``.

    Of the rows with equal payloads the one with the smallest page_id is a response; the others revisit it, and carry
    no payload.  Rows that repeat that id are responses too; a null id is never smaller than an id.  A null html is an
    empty payload.
    """
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    shared = rows.groupBy("digest").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # An outer join keeps the payloads where AQE can split a digest that many rows share.
    typed = rows.join(shared, "digest", "left").select(
        "page", "url", "payload", "first", (F.col("first").isNull() | F.col("page").eqNullSafe(F.col("first"))).alias("is_response")
    )

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in stream:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "payload", "first", "is_response"))):
                held.append(record(*row, level))
                size += len(held[-1])
                if size >= BLOB_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["blob"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["blob"])

    blobs = typed.mapInArrow(run, "blob binary").select(F.col("blob").cast("string").alias("value"))
    blobs.write.option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR.decode("latin-1")).text(path)


class _Range:
    """Bytes of a file from an offset on, fetched as they are needed."""

    def __init__(self, file: pa.NativeFile, start: int, size: int):
        self.file, self.start, self.size = file, start, size
        self.data = b""

    def more(self) -> bool:
        piece = self.file.read_at(min(READ_BYTES, self.size - self.start - len(self.data)), self.start + len(self.data))
        self.data += piece
        return bool(piece)


def members(file: pa.NativeFile, start: int, stop: int, size: int) -> Iterator[bytes]:
    """Inflated WARC records whose gzip members start in [start, stop) of the file."""
    window = _Range(file, start, size)
    while len(window.data) < min(stop + len(MAGIC), size) - start and window.more():
        pass
    at = 0
    while True:
        at = window.data.find(MAGIC, at)
        if at < 0 or start + at >= stop:
            return
        inflate = zlib.decompressobj(31)
        parts: list[bytes] = []
        fed = at
        begun = False
        try:
            while True:
                chunk = window.data[fed : fed + 65_536]
                fed += len(chunk)
                parts.append(inflate.decompress(chunk))
                if not begun:
                    begin = b"".join(parts)[:7]
                    if not b"WARC/1.".startswith(begin):
                        break
                    begun = len(begin) == 7
                if inflate.eof or (fed >= len(window.data) and not window.more()):
                    break
        except zlib.error:
            begun = False
        if begun and inflate.eof:
            yield b"".join(parts)
            at = fed - len(inflate.unused_data)
        else:
            at += 1


def parse(data: bytes) -> tuple:
    """Fields of :data:`RECORD` from an inflated record; the digest of a response is computed from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    number = lambda name: int(fields[name]) if fields.get(name, "None") != "None" else None
    digest, length, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"]), None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        digest, length = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    return number("X-Page-ID"), length, digest, fields["WARC-Type"], number("X-Refers-To-Page"), fields.get("WARC-Target-URI"), payload


def read_warc(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """Records of all archives under ``path``; ``range_bytes`` is the length of the byte range that a task scans.

    Spark lists the files; the ranges are opened with ``pyarrow.fs``, so the archives must be on a file system that it
    knows (a local or mounted path, S3, GCS, HDFS).  A range without the start of a record gives no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    ranges = files.select("path", "length").filter("length > 0").select(
        "path", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))).alias("start")
    )
    schema = RECORD if payloads else T.StructType(RECORD.fields[:-1])
    names = schema.fieldNames()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][: len(names)]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "start"))):
                system, inner = fs.FileSystem.from_uri(name if "://" in name else name.replace("file:/", "file:///", 1))
                with system.open_input_file(inner) as file:
                    held, size_held = [], 0
                    for data in members(file, start, start + range_bytes, size):
                        held.append(parse(data)[: len(names)])
                        size_held += len(data) if payloads else 200
                        if size_held >= BLOB_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)
                            held, size_held = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    # One range per row group of the exchange: ranges, not files, are dealt to the tasks.
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(max(1, parallel)).mapInArrow(run, schema)
