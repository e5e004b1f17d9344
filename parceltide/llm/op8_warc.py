"""WARC archives: written from pages, read back, and assembled into captures.

Writing: each page gives a request, a response (or a revisit, if an earlier page has the same
payload) and a metadata record. The request and the metadata name the main record in
WARC-Concurrent-To. Records are lines of Spark's text writer whose line separator is the end of a
WARC record, so writing is an ordinary, committed Spark job; archives are gzip files of about
``ARCHIVE_BYTES`` of text.

Reading: archives are read as binary files and parsed record by record by Content-Length.

Assembly: requests and metadata join their main record through concurrent-to, one nested row per
capture. Identical page rows give identical records; the n-th request is joined to the n-th main
record, and any pairing of identical records gives the same rows.

Defined cases: null html is an empty payload, a null url writes no target, a null page_id is written
as an absent number and never chosen as the page to refer to while another exists. Of equal payloads
all rows with the smallest (page_id, url) are responses. No pages give no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from parceltide.llm import common
from parceltide.session import shared_dir

ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"  # captures carry no time of their own
END = "\r\n\r\n"
RECORD_SCHEMA = ("record_id string, kind string, concurrent_to string, refers_to string, "
                 "target string, payload_digest string, payload_bytes bigint, block binary")


def base32(hex_sha1: Column) -> Column:
    """Base32 of a 40-digit hex string: ten digits are eight base-32 digits."""
    parts = [F.lpad(F.conv(F.substring(hex_sha1, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(kind: str, *parts: Column) -> Column:
    text = F.concat_ws("\x1f", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts))
    return F.regexp_replace(F.md5(text), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$",
                            "<urn:uuid:$1-$2-$3-$4-$5>")


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def _record(kind: Column, record_id: Column, block: Column, *headers: Column) -> Column:
    return F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id),
        _header("WARC-Date", F.lit(DATE)), *headers,
        _header("Content-Length", F.octet_length(block)), F.lit("\r\n"), block)


def warc_records(pages: DataFrame) -> DataFrame:
    """One row per record, in a column ``value``; needs ``page_id``, ``url`` and ``html``."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        common.text_or_empty("html").alias("html"),
    ).withColumn("digest", base32(F.sha1("html")))
    # Null page_ids sort last, so they are referred to only if there is nothing else.
    first = rows.groupBy("digest").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("absent"), "page_id", "url")).alias("first"))
    rows = rows.join(first, "digest")
    own = F.struct(F.col("page_id").isNull().alias("absent"), "page_id", "url")
    rows = rows.select(
        "*", own.eqNullSafe(F.col("first")).alias("is_response"),
        # Header lines cannot hold line breaks.
        F.regexp_replace("url", r"[\r\n]", "%0A").alias("target"),
    )
    main_id = _uuid("capture", F.col("page_id"), F.col("url"), F.col("digest"))
    first_id = _uuid("capture", F.col("first.page_id"), F.col("first.url"), F.col("digest"))
    target = _header("WARC-Target-URI", F.col("target"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    _header("Content-Length", F.octet_length("html")), F.lit("\r\n"))
    main_kind = F.when(F.col("is_response"), F.lit("response")).otherwise(F.lit("revisit"))
    refers = F.when(~F.col("is_response"), first_id)
    main = _record(
        main_kind, main_id, F.when(F.col("is_response"), F.concat(http, F.col("html"))).otherwise(http),
        target, _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Refers-To", refers),
        _header("WARC-Profile", F.when(~F.col("is_response"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"))
    request = _record(
        F.lit("request"), _uuid("request", main_id),
        F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_extract(
            "target", r"^[a-zA-Z][^:/?#]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/")),
            F.lit(" HTTP/1.1\r\n\r\n")),
        target, _header("WARC-Concurrent-To", main_id),
        F.lit("Content-Type: application/http;msgtype=request\r\n"))
    fields = F.concat(_header("page-id", F.col("page_id")),
                      _header("refers-to-page", F.when(~F.col("is_response"), F.col("first.page_id"))))
    metadata = _record(
        F.lit("metadata"), _uuid("metadata", main_id), fields, target,
        _header("WARC-Concurrent-To", main_id), F.lit("Content-Type: application/warc-fields\r\n"))
    return rows.select(F.explode(F.array(request, main, metadata)).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Archives below ``path``. A task starts a new file after as many records as make about
    ``ARCHIVE_BYTES``, so archives stay small without another shuffle of the payloads."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + 2048  # with the headers of three records
    mean = pages.agg(F.avg(size)).first()[0] or 2048.0
    warc_records(pages).write.option("lineSep", END).option("compression", "gzip").option(
        "maxRecordsPerFile", max(3, int(3 * ARCHIVE_BYTES / mean))).text(path)


class Records:
    """Parses the records of one archive from the pieces of its inflated bytes."""

    _HEAD_END = b"\r\n\r\n"

    def parse(self, archive: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
        data = self._inflate(archive) if archive[:2] == b"\x1f\x8b" else archive
        at = 0
        while at < len(data):
            if data.startswith(b"\r\n", at):  # the end of a record, or padding between two
                at += 2
                continue
            head_end = data.find(self._HEAD_END, at)
            if not data.startswith(b"WARC/", at) or head_end < 0:
                raise ValueError(f"no WARC record at byte {at}")
            lines = data[at:head_end].split(b"\r\n")[1:]
            headers = {k.lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines)}
            begin = head_end + 4
            at = begin + int(headers[b"content-length"])
            if at > len(data):
                raise ValueError("the archive ends within a record")
            yield headers, data[begin:at]

    @staticmethod
    def _inflate(archive: bytes) -> bytes:
        """All members of a gzip file."""
        out = bytearray()
        while archive:
            member = zlib.decompressobj(wbits=31)
            out += member.decompress(archive) + member.flush()
            archive = member.unused_data
        return bytes(out)


def _http_body(headers: dict[bytes, bytes], block: bytes) -> tuple[bytes, int | None, str | None]:
    """HTTP head, length and digest of the full payload. They are taken from the payload itself; a
    revisit carries none, so its headers tell."""
    head, _, body = block.partition(b"\r\n\r\n")
    if headers[b"warc-type"] == b"response":
        return head, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
    length = re.search(rb"(?im)^content-length: *(\d+)", head)
    digest = headers.get(b"warc-payload-digest", b"sha1:").partition(b":")[2].decode()
    return head, int(length[1]) if length else None, digest or None


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below ``path``. Without ``payloads``, the block of a response is
    its HTTP head: enough to assemble captures without shuffling what they hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    schema = pa.schema([(n, pa.string()) for n in (
        "record_id", "kind", "concurrent_to", "refers_to", "target", "payload_digest")] +
        [("payload_bytes", pa.int64()), ("block", pa.binary())])
    names = [b"warc-record-id", b"warc-type", b"warc-concurrent-to", b"warc-refers-to",
             b"warc-target-uri"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows: list[list] = []
                for headers, block in Records().parse(archive.as_py()):
                    size = digest = None
                    if headers[b"warc-type"] in (b"response", b"revisit"):
                        head, size, digest = _http_body(headers, block)
                        block = block if payloads else head
                    rows.append([headers[n].decode() if n in headers else None for n in names] +
                                [digest, size, block])
                    if len(rows) == common.ARROW_ROWS:
                        yield _batch(rows, schema)
                        rows = []
                if rows:
                    yield _batch(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD_SCHEMA)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record`` (response or revisit), ``request``, ``metadata``."""

    def numbered(kinds: list[str], key: str, name: str) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(key).orderBy("record_id"))
        return records.filter(F.col("kind").isin(kinds)).select(
            F.col(key).alias("capture_id"), nth.alias("nth"),
            F.struct(*records.columns).alias(name))

    main = numbered(["response", "revisit"], "record_id", "record")
    request = numbered(["request"], "concurrent_to", "request")
    metadata = numbered(["metadata"], "concurrent_to", "metadata")
    return main.join(request, ["capture_id", "nth"], "left").join(
        metadata, ["capture_id", "nth"], "left").drop("nth")


def captures_digest(captures: DataFrame) -> DataFrame:
    meta = F.decode("metadata.block", "utf-8")
    field = lambda name: F.nullif(
        F.regexp_extract(meta, rf"(?:^|\n){name}: (-?\d+)", 1), F.lit("")).cast("bigint")
    return captures.select(
        field("page-id").alias("page_id"), F.col("record.payload_bytes").alias("payload_bytes"),
        F.col("record.payload_digest").alias("payload_digest"),
        F.col("record.kind").alias("record_type"), field("refers-to-page").alias("refers_to"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archives(common.table(spark, sf_dir, "pages"), path)
    return captures_digest(assemble(read_records(spark, path, payloads=False)))


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
       (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4)))) & 31)::INT + 1, 1), ''
       ORDER BY i) FROM range(32) t(i)) AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM w
"""
