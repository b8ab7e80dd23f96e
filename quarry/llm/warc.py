"""WARC archives: write, read, resolve revisits, write deduplicated archives.

``write_archives`` makes one WARC/1.1 response record per page, each its own
gzip member, in ``*.gz`` part files of at most ``RECORDS_PER_FILE`` records
(through :mod:`quarry.llm.binary_sink`, so any shared file system will do and
a lost task is simply run again).  ``read_archives`` parses records by their
Content-Length, so a payload may hold anything, also text that looks like
a record.

``resolve_revisits`` works on headers alone: (digest, length) groups are
pre-aggregated to the record with the largest page id, groups of one are left
out, and the headers meet the remaining originals in a join of two staged
tables, where AQE can split a digest that holds a third of all rows.
``write_deduplicated`` sends each archive's decisions to the task that rewrites
it: originals with fresh headers, copies as revisit records that refer to them.
No payload is shuffled.

Defined results: a null payload is empty; a null page id is the smallest; of
rows with equal page ids and payloads one is the response and the others
revisit it; records below ``min_bytes`` are all responses; an empty table
writes no archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.binary_sink import gzip_member, open_members, write_blobs
from quarry.llm.common import staged

RECORDS_PER_FILE = 5_000
TASK_BYTES = 16 << 20  # payload for which there is one rewriting task
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"

HEADERS = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("place", T.LongType()),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to_id", T.StringType()), T.StructField("refers_to_page", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType())])


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [b"WARC/1.1"]
    lines += [f"{k}: {' '.join(v.split())}".encode() for k, v in fields if v is not None]
    lines.append(f"Content-Length: {len(block)}".encode())
    return CRLF.join(lines) + CRLF * 2 + block + CRLF * 2


def _http(payload_bytes: int) -> bytes:
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n").encode()


def response(page_id, url, payload: bytes, record_id: str, date: str = DATE, payload_digest: str | None = None) -> bytes:
    block = _http(len(payload)) + payload
    return _record([("WARC-Type", "response"), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", url),
                    ("WARC-Payload-Digest", "sha1:" + (payload_digest or digest(payload))), ("WARC-Block-Digest", "sha1:" + digest(block)),
                    ("Page-ID", None if page_id is None else str(page_id)),
                    ("Content-Type", "application/http; msgtype=response")], block)


def revisit(page_id, url, payload_bytes: int, payload_digest: str, record_id: str, original: tuple, date: str = DATE) -> bytes:
    """``original``: record id, page id, url and date of the record that holds the payload."""
    block = _http(payload_bytes)  # the HTTP headers only
    rid, rpage, rurl, rdate = original
    return _record([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Target-URI", url),
                    ("WARC-Profile", PROFILE), ("WARC-Refers-To", rid), ("WARC-Refers-To-Target-URI", rurl),
                    ("WARC-Refers-To-Date", rdate), ("WARC-Payload-Digest", "sha1:" + payload_digest),
                    ("WARC-Block-Digest", "sha1:" + digest(block)),
                    ("Page-ID", None if page_id is None else str(page_id)),
                    ("Refers-To-Page-ID", None if rpage is None else str(rpage)),
                    ("Content-Type", "application/http; msgtype=response")], block)


def parse_records(stream):
    """``(fields by lower-case name, block)`` of every record of an uncompressed stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError("a record ends early")
        yield fields, block


def payload_of(block: bytes) -> tuple[int, bytes]:
    """The payload's length by the HTTP headers (a revisit's block ends with them), and the payload that is there."""
    head, _, payload = block.partition(CRLF * 2)
    return int(next(x.split(b":")[1] for x in head.split(CRLF) if x.lower().startswith(b"content-length"))), payload


def _new_id(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


_BLOBS = T.StructType([T.StructField("blob", T.BinaryType())])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("binary").alias("html"))

    def run(batches):
        from pyspark import TaskContext
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            out = []
            for i, url, html in zip(*[b.column(c).to_pylist() for c in ("id", "url", "html")]):
                out.append(gzip_member(response(i, url, html or b"", _new_id("page", task, n, i))))
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["blob"])

    write_blobs(rows.mapInArrow(run, _BLOBS), path, "blob", records_per_file=RECORDS_PER_FILE)


def read_archives(spark: SparkSession, path: str, payloads: bool | str = False) -> DataFrame:
    """The header fields of every record below ``path``, with ``payloads`` also its ``payload``."""
    schema = T.StructType([*HEADERS.fields, *([T.StructField("payload", T.BinaryType())] if payloads else [])])
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def rows_of(name, content):
        for place, (f, block) in enumerate(parse_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))))):
            length, payload = payload_of(block)
            kind = f["warc-type"]
            page, to_page = f.get("page-id"), f.get("refers-to-page-id")
            row = (name, place, page and int(page), f.get("warc-target-uri"), f.get("warc-date"), f["warc-record-id"], kind,
                   f.get("warc-refers-to"), to_page and int(to_page), length,
                   f["warc-payload-digest"].removeprefix("sha1:") if kind == "revisit" else digest(payload))
            yield (*row, payload) if payloads else row

    def run(batches):
        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
                name = name.rsplit("/", 1)[-1]
                held, size = [], 0
                for row in rows_of(name, content):
                    held.append(row)
                    size += len(row[-1]) + 100 if payloads else 100
                    if size > 16_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)],
                                                         names=schema.fieldNames())
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)],
                                                     names=schema.fieldNames())

    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
             pa.int64(), pa.string(), pa.binary()][:len(schema)]
    return files.mapInArrow(run, schema)


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Every header with ``new_type`` and, for revisits, the original's ``o_*`` fields.

    ``headers`` should be a staged table; it is read twice.
    """
    key = ["payload_digest", "payload_bytes"]
    best = F.max(F.struct(F.col("page_id"), F.col("archive"), F.col("place"), F.col("record_id"), F.col("url"), F.col("date")))
    originals = staged(headers.where(F.col("payload_bytes") >= min_bytes).groupBy(*key)
                       .agg(best.alias("o"), F.count(F.lit(1)).alias("n")).where("n > 1")
                       .select(*key, *[F.col(f"o.{c}").alias(f"o_{c}") for c in
                                       ("page_id", "archive", "place", "record_id", "url", "date")]), "warc-originals")
    other = F.col("o_record_id").isNotNull() & ~((F.col("archive") == F.col("o_archive")) & (F.col("place") == F.col("o_place")))
    joined = headers.join(originals, key, "left").withColumn("new_type", F.when(other, "revisit").otherwise("response"))
    revisits = F.col("new_type") == "revisit"
    return joined.select(*headers.columns, "new_type", *[F.when(revisits, F.col(c)).alias(c) for c in
                                                         ("o_page_id", "o_record_id", "o_url", "o_date")])


def write_deduplicated(spark: SparkSession, source: str, resolved: DataFrame, path: str) -> None:
    """Archives in which copies are revisit records; all headers are written afresh.

    Only decisions are shuffled: a task gets those of whole archives in the order of their
    records, opens each archive once and rewrites it record by record.
    """
    names = ["archive", "place", "payload_digest", "new_type", "o_record_id", "o_page_id", "o_url", "o_date"]
    archives, size = resolved.agg(F.countDistinct("archive"), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()
    tasks = max(1, min(archives, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))))
    decisions = resolved.select(*names).repartitionByRange(tasks, "archive").sortWithinPartitions("archive", "place")

    def run(batches):
        name, records = None, iter(())
        for b in batches:
            out, held = [], 0
            for archive, place, dig, kind, *original in zip(*[b.column(c).to_pylist() for c in names]):
                if archive != name:
                    name, records = archive, enumerate(parse_records(open_members(f"{source}/{archive}")))
                at, (f, block) = next(records)
                if at != place:
                    raise ValueError(f"record {place} of {archive} has no decision")
                length, payload = payload_of(block)
                page, rid, url, date = f.get("page-id"), f["warc-record-id"], f.get("warc-target-uri"), f.get("warc-date")
                page = page and int(page)
                out.append(gzip_member(response(page, url, payload, rid, date, dig) if kind == "response" else
                                       revisit(page, url, length, dig, rid, tuple(original), date)))
                held += len(out[-1])
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["blob"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["blob"])

    write_blobs(decisions.mapInArrow(run, _BLOBS), path, "blob", records_per_file=RECORDS_PER_FILE)


def deduplicate(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives, resolve revisits, write deduplicated archives and return their headers."""
    spark = pages.sparkSession
    write_archives(pages, f"{path}/captured", id_col, url_col, html_col)
    if not spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/captured").select("path").take(1):
        return spark.createDataFrame([], HEADERS)
    headers = staged(read_archives(spark, f"{path}/captured"), "warc-headers")
    write_deduplicated(spark, f"{path}/captured", resolve_revisits(headers, min_bytes), f"{path}/deduplicated")
    return read_archives(spark, f"{path}/deduplicated")
