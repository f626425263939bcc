"""WARC archives in which equal payloads are stored once.

Only headers are shuffled to find equal payloads: digest, length and page id, combined before the shuffle, so a payload
held by a third of all pages is one row per task. The page with the smallest id keeps its payload as a response; the
others become revisit records that name it. The marks of the revisits are written as a table and joined to the pages by
id; while Spark finds that table small enough to broadcast, no payload leaves its task, beyond that the pages are
shuffled once by id and digest. The records are then written as WARC 1.1 text by Spark's own writer, as gzip archives of
some 256 MB of text at most on average, to any file system Spark reaches.

Reading splits the archives by the lengths in their headers, checks every payload against its digest, and joins
revisits to their responses for what the revisits leave out.

Defined cases: missing html is an empty payload; a missing url leaves the target out; pages without an id are responses
and nobody's original; of repeated rows with the smallest id each is a response; no pages make no archive. Columns
other than page_id, url and html are left out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.llm import texts
from aeropanel.session import scratch_path

MIN_BYTES = 0
ARCHIVE_BYTES = 256_000_000
HEADER_BYTES = 600
# fixed values of the format
VERSION = "WARC/1.1"
LINE = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload string"


def base32(hexed: Column) -> Column:
    """Base32 of 20 bytes given as 40 hexadecimal digits: five of these are four letters."""
    letters = []
    for at in range(0, 40, 5):
        value = F.conv(F.substring(hexed, at + 1, 5), 16, 10).cast("long")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), (F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


def with_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes and payload_digest of pages (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    told = pages.select("page_id", "url", payload.alias("payload"))
    return told.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": base32(F.sha1(F.col("payload").cast("binary")))})


KEY = ["page_id", "payload_digest", "payload_bytes"]


def revisits(headers: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, payload_digest, payload_bytes and refers_to of the headers that are revisits, each once; written to `path`.

    Only digests of several pages are joined back, so unique pages find no partner.
    """
    told = headers.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    shared = told.groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes")).agg(
        F.min("page_id").alias("refers_to"), F.max("page_id").alias("_last")).filter(F.col("_last") > F.col("refers_to")).drop("_last")
    met = told.join(shared, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_bytes")))
    # written before repeats go, as a grouping right behind the join would keep a frequent digest in one task
    met.filter(F.col("page_id") > F.col("refers_to")).select(*KEY, "refers_to").write.parquet(path)
    return headers.sparkSession.read.parquet(path).distinct()


def resolved(records: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds record_type and refers_to to records with page_id, payload_digest and payload_bytes."""
    return records.join(marks, KEY, "left").withColumn(
        "record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def _record_id(page_id: Column) -> Column:
    hexed = F.md5(F.concat(F.lit("page "), page_id.cast("string")).cast("binary"))
    cuts = [F.substring(hexed, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, nothing if there is no value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(LINE)), F.lit(""))


def record_text(date: str) -> Column:
    """One whole record but for its last line feed, which the writer adds."""
    is_revisit = F.col("record_type") == "revisit"
    # control characters would end a header line
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    block = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(LINE + LINE),
                     F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    return F.concat(
        F.lit(VERSION + LINE), _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _record_id(F.coalesce(F.col("page_id").cast("string"), F.col("payload_digest")))),
        _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", url),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(is_revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(is_revisit, _record_id(F.col("refers_to")))),
        _field("X-Page-ID", F.col("page_id")), _field("X-Refers-To-Page-ID", F.col("refers_to")),
        _field("X-Has-Target", F.when(F.col("url").isNull(), F.lit("no"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")), _field("Content-Length", F.octet_length(block)),
        F.lit(LINE), block, F.lit(LINE + "\r"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes pages (page_id, url, html) as deduplicated archives below `path`."""
    spark = pages.sparkSession
    scratch = scratch_path(spark, "warc-headers")
    with_digest(pages).select(*KEY).write.parquet(f"{scratch}/headers")
    headers = spark.read.parquet(f"{scratch}/headers")
    mean = headers.agg(F.avg("payload_bytes")).first()[0] or 0.0
    records = resolved(with_digest(pages), revisits(headers, f"{scratch}/revisits", min_bytes))
    records.select(record_text(date).alias("value")).write.option("lineSep", "\n").option(
        "maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / (mean + HEADER_BYTES)))).text(path, compression="gzip")


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive: their headers, and `payload` for those that hold one."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split(LINE)
        if first != VERSION:
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        begin, size = end + 4, int(fields["Content-Length"])
        block = data[begin:begin + size]
        if data[begin + size:begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where it says")
        fields["payload"] = block[block.index(b"\r\n\r\n") + 4:]
        yield fields
        at = begin + size + 4


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
                        ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.string())])
    for batch in batches:
        for data in batch.column("content"):
            rows, held = [], 0
            for f in parse_archive(gzip.decompress(data.as_py())):
                digest, payload = f["WARC-Payload-Digest"].removeprefix("sha1:"), f["payload"]
                revisit = f["WARC-Type"] == "revisit"
                if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload of page {f.get('X-Page-ID')} does not match its digest")
                number = lambda name: int(f[name]) if name in f else None  # noqa: E731, B023
                url = None if f.get("X-Has-Target") == "no" else f.get("WARC-Target-URI", "")
                rows.append({"page_id": number("X-Page-ID"), "url": url, "record_type": f["WARC-Type"], "payload_digest": digest,
                             "payload_bytes": None if revisit else len(payload), "refers_to": number("X-Refers-To-Page-ID"),
                             "payload": None if revisit else payload.decode()})
                held += len(payload)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below `path` as they are stored; payload and payload_bytes of revisits are null."""
    files = spark.read.format("binaryFile").load(path).select("content")
    found = texts.map_batches(files, _parsed, RECORD)
    return found if payloads else found.drop("payload")


def with_originals(records: DataFrame) -> DataFrame:
    """Joins revisits to the responses they name, for the length and, if it is there, the payload they leave out.

    Only responses that a revisit names are looked for; a response is one row per page, so a payload with very many
    revisits splits on their side.
    """
    carried = [c for c in ("payload_bytes", "payload") if c in records.columns]
    revisits = records.filter(F.col("record_type") == "revisit").drop(*carried)
    named = revisits.groupBy(F.col("refers_to").alias("_page")).agg(F.count("*").alias("_n")).drop("_n")
    answers = records.filter(F.col("record_type") == "response").join(named, F.col("page_id") == F.col("_page"), "left_semi")
    answers = answers.groupBy(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest")).agg(
        *(F.max(c).alias(c) for c in carried))
    whole = revisits.join(answers, (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return records.filter(F.col("record_type") == "response").unionByName(whole.select(*records.columns))


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, read back from its archive."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    records = read_archives(spark, path, payloads=False)
    return with_originals(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
