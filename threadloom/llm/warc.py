"""WARC archives: records written with an index, and read back by coalesced byte ranges.

Every task writes its rows to files of its own in a shared folder, one gzip member per record, and returns one index row
per record: file, offset, length, url and digest.  The index is written as a table; only files that it names count, so a
task that is repeated after a loss leaves at most an unused file.  A reader takes index rows, puts those of one stretch
of a file together, sorts them by offset and reads near ranges with one request.

Rows with equal payloads (SHA-256) of at least ``min_bytes``: that with the largest id is a ``response``, the others are
``revisit`` records that refer to it and carry no payload, only its digest and, in the HTTP header, its length.  The join
that finds the partner moves each page once, and AQE splits hot payloads.

Defined cases: a null payload is empty.  Rows that repeat the largest id of a payload are all responses; a null id counts
as smaller than all others, and if a payload has only null ids its rows are responses.  A null url is written as an empty
one; line breaks in urls are percent-encoded in headers.  Payloads of any size are one record; a record must fit in a
task's memory.  An empty table gives an empty index.  Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path, stage
from .common import prepare

FILE_BYTES = 256 << 20
STRETCH_BYTES = 4 << 20
#: Ranges nearer than this are read with one request.
GAP_BYTES = 64 << 10
REQUEST_BYTES = 8 << 20
LEVEL = 6

_INDEX = pa.schema([
    ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("record_type", pa.string())])
_INDEX_TYPE = "page_id long, file string, offset long, length long, url string, payload_digest string, record_type string"
_READ_TYPE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, kind: str, refers_to: int | None, warc_date: str) -> tuple[bytes, str]:
    """One WARC/1.1 record (not compressed) and its payload digest."""
    mark = digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{uri}|{mark}')}>",
        f"WARC-Date: {warc_date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{mark}",
        f"Content-Type: application/http;msgtype=response", f"X-Page-ID: {'' if page_id is None else page_id}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return head + block + b"\r\n\r\n", mark


def parse(data: bytes) -> dict:
    """The fields of one record; digest and length of a response are those of the payload itself."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["WARC-Type"]
    claimed = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    if kind == "response" and (digest(payload) != claimed or len(payload) != length):
        raise ValueError(f"damaged record: {fields['WARC-Record-ID']}")
    refers = fields.get("X-Refers-To-Page-ID")
    return {"page_id": int(fields["X-Page-ID"]) if fields["X-Page-ID"] else None, "payload_bytes": length, "payload_digest": claimed,
            "record_type": kind, "refers_to": int(refers) if refers else None, "payload": payload if kind == "response" else None}


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of a shared folder: a local or mounted path, or a URI that Arrow knows (hdfs, s3, gs)."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def marked(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Pages with ``record_type`` and ``refers_to``."""
    held = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    held = held.withColumn("mark", F.when(F.octet_length("html") >= min_bytes, F.unhex(F.sha2("html", 256))))
    several = held.where("mark is not null").groupBy("mark").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 and last is not null").select("mark", "last")
    joined = held.join(several, "mark", "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "html", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("last")).alias("refers_to"))


def write(pages: DataFrame, path: str, min_bytes: int = 0, warc_date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write archives under ``path`` and return the index, which is stored as a table beside them."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(path)
        system.create_dir(folder, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= FILE_BYTES:
                    if out:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{folder}/{name}", compression=None)
                data, mark = record(page_id, url, html.encode(), kind, refers_to, warc_date)
                member = gzip.compress(data, LEVEL, mtime=0)
                out.write(member)
                rows.append((page_id, name, at, len(member), url, mark, kind))
                at += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _INDEX.types)], schema=_INDEX)
        if out:
            out.close()

    return stage(marked(pages, min_bytes).mapInArrow(run, _INDEX_TYPE), "warc-index")


def read(index: DataFrame, path: str) -> DataFrame:
    """The records that ``index`` rows name, payloads included (null in revisits)."""
    prepare(index.sparkSession)
    picked = index.select("file", "offset", "length")
    tasks = 1 + (picked.agg(F.sum("length").alias("n")).first()["n"] or 0) // STRETCH_BYTES  # by archive bytes: the rows themselves are few
    near = picked.repartition(tasks, F.col("file"), F.floor(F.col("offset") / STRETCH_BYTES)).sortWithinPartitions("file", "offset")
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(path)
        for batch in batches:
            for name, begin, end, ranges in coalesce(zip(*(c.to_pylist() for c in batch.columns))):
                with system.open_input_file(f"{folder}/{name}") as file:
                    file.seek(begin)
                    data = file.read(end - begin)
                rows = [parse(zlib.decompress(data[a - begin:a - begin + n], 31)) for a, n in ranges]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return near.mapInArrow(run, _READ_TYPE)


def coalesce(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) rows as requests (file, begin, end, ranges)."""
    name, begin, end, ranges = "", 0, 0, []
    for file, offset, length in rows:
        if ranges and (file != name or offset - end > GAP_BYTES or offset + length - begin > REQUEST_BYTES):
            yield name, begin, end, ranges
            ranges = []
        if not ranges:
            name, begin, end = file, offset, offset
        ranges.append((offset, length))
        end = max(end, offset + length)
    if ranges:
        yield name, begin, end, ranges


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages as archives in the shared folder and read every record back."""
    path = shared_path(pages.sparkSession, "warc")
    return read(write(pages, path, min_bytes), path)
