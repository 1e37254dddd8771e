"""WARC archives with dictionary-compressed records.

Every page becomes one record: a response with its payload, or a revisit that
points to the response of an equal payload. An archive file is a run of
Zstandard frames: first a skippable frame (``DICT_MAGIC``) that holds a
dictionary built from records of the file, then one frame per record, each
decompressed alone with that dictionary, and at the end a skippable frame of
one byte. A warcinfo record comes first.

Files are written and read by Spark's own file sources, so any file system
Spark knows will do. The text writer ends each file with a line feed: it is
that last frame's one byte.

Which record is the response is one aggregation on the payload's digest,
combined before the shuffle; payloads are only shuffled when the table of
repeated digests is too large to broadcast.

Defined cases: a null html is an empty payload; a null url leaves out the
target; a null page_id never leads a group of equal payloads; repeated rows
of the leading page_id are all responses; an empty table writes no record.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import bounded_broadcast, pin, spread
from .spans import batches

# Fixed values of the format: the dictionary's frame, and any other skippable one.
DICT_MAGIC = 0x184D2A5D
SKIP_MAGIC = 0x184D2A50
MIN_REVISIT_BYTES = 1000
FILE_BYTES = 16 << 20
DICT_BYTES = 32 << 10
BROADCAST_ROWS = 200_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``head`` (the page whose
    response holds this payload, null for a response)."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = spread(pages.select("page_id", "url", payload.alias("payload"))).withColumn("digest", F.sha1("payload"))
    long_ = rows.where(F.octet_length("payload") >= min_bytes)
    groups = long_.groupBy("digest").agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1 and head is not null")
    heads = bounded_broadcast(pin(groups.select("digest", "head")), BROADCAST_ROWS)
    return rows.join(heads, "digest", "left").withColumn(
        "head", F.when(F.col("page_id").eqNullSafe(F.col("head")), F.lit(None)).otherwise(F.col("head")))


def _page(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url, payload: bytes, digest: str, head, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", _page(page_id)), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url)))
    if head is None:
        return _record("response", headers, http + payload)
    return _record("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", _page(head))], http)


def _archive(records: list[bytes], date: str) -> bytes:
    """One file without its last byte."""
    info = _record("warcinfo", [("WARC-Record-ID", "<urn:page:info>"), ("WARC-Date", date),
                                ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
    step = max(1, sum(map(len, records)) // (64 * DICT_BYTES))
    try:
        words = zstandard.train_dictionary(DICT_BYTES, records[::step])
    except zstandard.ZstdError:  # too few records to learn from: their bytes are the dictionary
        words = zstandard.ZstdCompressionDict(b"".join(records)[:DICT_BYTES] or b"WARC/1.1\r\n")
    press = zstandard.ZstdCompressor(level=3, dict_data=words)
    raw = words.as_bytes()
    return b"".join([struct.pack("<II", DICT_MAGIC, len(raw)), raw, *(press.compress(r) for r in (info, *records)),
                     struct.pack("<II", SKIP_MAGIC, 1)])


def write_archives(planned: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write ``plan_records`` rows as archive files of about ``file_bytes``
    uncompressed, one file each."""

    def run(parts):
        records, size = [], 0
        for part in batches(parts):
            for row in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "head"))):
                records.append(page_record(*row, date))
                size += len(records[-1])
                if size >= file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([_archive(records, date)], pa.binary())], ["file"])
                    records, size = [], 0
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([_archive(records, date)], pa.binary())], ["file"])

    files = planned.select("page_id", "url", "payload", "digest", "head").mapInArrow(run, "file binary")
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def records_of(raw: bytes):
    """The records of one archive file, one after the other."""
    view, at, words = memoryview(raw), 0, None
    unpack = None
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == SKIP_MAGIC:
            if magic == DICT_MAGIC:
                words = zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size]))
            at += 8 + size
            continue
        unpack = unpack or zstandard.ZstdDecompressor(dict_data=words)
        frame, out = unpack.decompressobj(), []
        while not frame.eof:
            piece = view[at:at + (1 << 16)]
            if not len(piece):
                raise ValueError("archive ends inside a record")
            out.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(out)


def parse_record(record: bytes) -> tuple[dict, bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def _id(text: str | None):
    value = None if text is None else text[len("<urn:page:"):-1]
    return None if value in (None, "null") else int(value)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record of the archive files, payloads checked."""

    def run(parts):
        for part in batches(parts):
            for file in part.column("content"):
                rows = []
                for fields, block in map(parse_record, records_of(file.as_py())):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                    if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                    rows.append((_id(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], _id(fields.get("WARC-Refers-To"))))
                columns = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").load(path)
    return files.select("content").mapInArrow(run, ROWS)
