"""WARC archives with revisit resolution.

Headers (key, payload size, payload digest) are shuffled by digest: the
records of one payload agree on the smallest key, which stays the original
response; the others become revisit records that point to it and carry no
payload.  Archives are written with fresh headers (own record ids, lengths and
digests) through Spark's text writer: a record is one value and the record
terminator CRLF CRLF is the line separator, so commits, retries and file
systems are Spark's.  Reading takes the files back as binary rows (their size
is bounded by ``RECORDS_PER_FILE``), parses records by Content-Length, and
joins revisits to their responses for what the response alone holds.

The groups of equal payloads are combined map-side before the shuffle, and
only payloads seen twice or more are joined back; that side is broadcast if
its counted size is small, and otherwise joined by a skew-aware sort-merge
join, so that copies of one payload may be a third of all pages.

Defined results: a null payload is empty; payloads below ``MIN_REVISIT_BYTES``
are always responses; rows that repeat the smallest key of a payload are all
responses; a null key is never an original (a group with null keys only is all
responses).  A null or multi-line url gets a safe target URI.  An empty table
writes no record and reads back none.  Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, sized_broadcast, written

MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 2000
TERMINATOR = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"       # fixed record date: the tables carry none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def resolve_revisits(pages: DataFrame, key: str, payload: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` with payload_bytes, payload_digest, record_type, refers_to."""
    headed = pages.withColumn("payload_bytes", F.octet_length(payload).cast("bigint")) \
                  .withColumn("payload_digest", F.sha2(F.encode(F.col(payload), "UTF-8"), 256))
    shared = (headed.where(F.col("payload_bytes") >= min_bytes)
              .groupBy("payload_digest").agg(F.min(key).alias("_original"), F.count(F.lit(1)).alias("_n"))
              .where("_n > 1 and _original is not null").select("payload_digest", "_original"))
    shared = written(shared, "warc-shared")
    d = headed.join(sized_broadcast(shared, shared.count()), "payload_digest", "left")
    copy = F.col("_original").isNotNull() & ~F.col(key).eqNullSafe(F.col("_original"))
    return d.withColumn("record_type", F.when(copy, "revisit").otherwise("response")) \
            .withColumn("refers_to", F.when(copy, F.col("_original"))).drop("_original")


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
                    F.lit(">"))


def _lines(*pairs: tuple[str, Column | str]) -> Column:
    made = []
    for name, value in pairs:
        value = F.lit(value) if isinstance(value, str) else value.cast("string")
        made.append(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))
    return F.concat_ws("", *made)      # a null value leaves its header out


def record_text(key: str, url: str, payload: str) -> Column:
    """One WARC record without its terminator, from a resolved row."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"),
                    _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("payload_bytes"))),
                    F.lit("\r\n"))
    target = F.regexp_replace(F.coalesce(F.col(url), F.concat(F.lit("urn:page:"), F.col(key).cast("string")),
                                         F.lit("urn:page:")), r"\s", "%20")
    block = F.when(revisit, http).otherwise(F.concat(http, F.col(payload)))
    digest = F.concat(F.lit("sha256:"), F.col("payload_digest"))
    own = _uuid(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col("payload_digest"), F.lit("record"))
    first = _uuid(F.col("refers_to").cast("string"), F.col("payload_digest"), F.lit("record"))
    head = _lines(
        ("WARC-Type", F.col("record_type")), ("WARC-Record-ID", own), ("WARC-Date", DATE),
        ("WARC-Target-URI", target), ("WARC-Payload-Digest", digest),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))), ("WARC-Refers-To", F.when(revisit, first)),
        ("X-Page-Id", F.col(key)), ("X-Refers-To-Page-Id", F.col("refers_to")),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", F.octet_length(block)))
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), block)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url",
                   payload: str = "html") -> None:
    """Write one record per row to gzip archives under ``path``."""
    src = pages.select(F.col(key), F.col(url).cast("string").alias(url),
                       F.coalesce(F.col(payload).cast("string"), F.lit("")).alias(payload))
    resolved = resolve_revisits(src, key, payload)
    (resolved.select(record_text(key, url, payload).alias("value")).write
     .option("lineSep", TERMINATOR).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


_HEADER = re.compile(rb"([^:\r\n]+): *([^\r\n]*)\r\n")
RECORD_SCHEMA = ("page_id bigint, record_type string, url string, refers_to bigint, payload_digest string, "
                 "payload_bytes bigint, actual_digest string, payload binary")


def parse_records(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of each record of one archive, by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end + 2]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.decode().lower(): v.decode() for k, v in _HEADER.findall(head[head.index(b"\r\n") + 2:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != TERMINATOR.encode():
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield fields, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record: page_id, record_type, url, refers_to, payload_digest
    (as stated), payload_bytes and actual_digest (of what is stored; null for
    revisits), payload."""
    from hashlib import sha256

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_type", "url", "refers_to", "payload_digest", "payload_bytes",
                 "actual_digest", "payload"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for raw in batch.column(0):
                rows = []
                for fields, block in parse_records(gzip.decompress(raw.as_py())):
                    body = block[block.index(b"\r\n\r\n") + 4:] if fields["warc-type"] == "response" else None
                    number = lambda k: int(fields[k]) if k in fields else None  # noqa: E731, B023
                    rows.append((number("x-page-id"), fields["warc-type"], fields["warc-target-uri"],
                                 number("x-refers-to-page-id"),
                                 fields["warc-payload-digest"].removeprefix("sha256:"),
                                 None if body is None else len(body),
                                 None if body is None else sha256(body).hexdigest(),
                                 body if with_payload else None))
                cols = list(zip(*rows)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(parse, RECORD_SCHEMA)


def archive_report(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to as read
    back: a response by its stored payload, a revisit by its response's."""
    read = written(read_archives(spark, path, with_payload=False).drop("payload", "url"), "warc-read")
    responses = read.where("record_type = 'response'")
    cited = written(read.where("refers_to is not null").select(F.col("refers_to").alias("page_id")).distinct(),
                    "warc-cited")
    originals = responses.join(sized_broadcast(cited, cited.count()), "page_id", "left_semi")
    originals = written(originals.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest"))
                        .agg(F.max("payload_bytes").alias("_b"), F.max("actual_digest").alias("_d")), "warc-originals")
    own = responses.select("page_id", "payload_bytes", F.col("actual_digest").alias("payload_digest"),
                           "record_type", "refers_to")
    pointed = (read.where("record_type = 'revisit'").drop("payload_bytes", "actual_digest")
               .join(sized_broadcast(originals, originals.count()), ["refers_to", "payload_digest"], "left")
               .select("page_id", F.col("_b").alias("payload_bytes"), F.col("_d").alias("payload_digest"),
                       "record_type", "refers_to"))
    return own.unionByName(pointed)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and report what they hold."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path)
    return archive_report(pages.sparkSession, path)
