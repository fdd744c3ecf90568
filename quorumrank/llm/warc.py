"""A content-addressed web archive: payloads once by digest, exact record headers apart, records rebuilt by joins.

Two tables make an archive. ``payloads`` holds each distinct payload once under its SHA-256. ``records`` holds for
each record the exact bytes of its WARC header block and the payload's digest. A page whose payload another page has
already is a revisit of that page. Reading verifies every payload against its digest and length, and a record's bytes
are its header block, its payload (responses only) and the closing line ends. Joins are between written tables, so a
payload that millions of pages share is split between tasks by the skew handling of the planner.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import forget, pick, shared_dir, stored

_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_DATE = "2000-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data: five hex digits are four of base 32."""
    digest = F.sha1(data)
    return F.concat(
        *[F.translate(F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0"), _HEX32, _BASE32) for i in range(8)]
    )


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive lie."""

    path: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/payloads")

    def records(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/records")


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))


def _one_line(value: Column) -> Column:
    """A header value can't hold line ends: those, and the escape sign itself, are percent-encoded."""
    for char, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        value = F.replace(value, F.lit(char), F.lit(code))
    return value


def _record_id(page_id: Column, row: Column) -> Column:
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">")
    )


def write_archive(pages: DataFrame, path: str | None = None, revisit_from: int = 0) -> Archive:
    """Archives a record per row of ``pages(page_id, url, html)``; null html is an empty payload, a null url no target.

    Of rows with equal payloads of ``revisit_from`` bytes or more, that with the smallest page_id is the response and
    the others, repeated rows included, revisit it; shorter payloads are all responses. Rows with a null id come
    after all others. Other columns are ignored.
    """
    spark = pages.sparkSession
    archive = Archive(path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    rows = pick(pages, "page_id", "url", "html").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    digest = F.sha2("payload", 256)
    # A map-side aggregate keeps one payload per digest and task, so copies never travel.
    (
        rows.select(digest.alias("digest"), "payload").groupBy("digest").agg(F.first("payload").alias("payload"))
        .withColumn("bytes", F.octet_length("payload").cast("long")).write.parquet(f"{archive.path}/payloads")
    )
    # Rows are numbered once, in a written table: what is said of a row holds for it however often a task is run.
    index = rows.select(
        "page_id", "url", digest.alias("digest"), F.octet_length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("sha1")
    )
    index = stored(index.withColumn("row", F.monotonically_increasing_id()), "warc-index")
    row_key = F.struct(
        F.col("page_id").isNull().alias("n"), F.col("page_id").alias("p"), F.coalesce("url", F.lit("")).alias("u"),
        F.col("row").alias("r")
    )
    shared = index.where(F.col("bytes") >= revisit_from).groupBy("digest").agg(
        F.min(row_key).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    shared = stored(shared.where("rows > 1").select("digest", "first"), "warc-shared")
    joined = index.join(shared, "digest", "left")
    response = (F.col("bytes") < revisit_from) | F.col("first").isNull() | (F.col("row") == F.col("first.r"))
    kind = F.when(response, F.lit("response")).otherwise(F.lit("revisit"))
    headers = F.concat(
        F.lit("WARC/1.1\r\n"), _field("WARC-Type", kind), _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        _field("WARC-Date", F.lit(RECORD_DATE)), _field("WARC-Target-URI", _one_line(F.col("url"))),
        _field("WARC-Refers-To", F.when(~response, _record_id(F.col("first.p"), F.col("first.r")))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Profile", F.when(~response, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.when(response, F.col("bytes")).otherwise(F.lit(0)).cast("string")), F.lit("\r\n"),
    )
    joined.select("page_id", "digest", headers.cast("binary").alias("header")).write.parquet(f"{archive.path}/records")
    forget(spark, index)
    forget(spark, shared)
    return archive


def header_value(header: Column, name: str) -> Column:
    """A field's value in a header block, or null."""
    found = F.regexp_extract(F.concat(F.lit("\r\n"), header.cast("string")), f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(F.concat(F.lit("\r\n"), header.cast("string")), F.lit(f"\r\n{name}: ")), found)


def verified(spark: SparkSession, archive: Archive) -> DataFrame:
    """(digest, payload, bytes, sha1) of the payloads; one that doesn't match its digest or length fails the job."""
    rows = archive.payloads(spark)
    right = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("bytes"))
    payload = F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("corrupt payload "), F.col("digest"))).cast("binary")
    )
    return rows.select("digest", payload.alias("payload"), "bytes").withColumn("sha1", base32_sha1(F.col("payload")))


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The archive's records: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, record.

    ``record`` holds a record's exact bytes, ``payload`` the full payload, of revisits too. What a header says of its
    payload is checked against the verified one.
    """
    header = F.col("header")
    rows = archive.records(spark).join(verified(spark, archive), "digest", "left")
    of_type = header_value(header, "WARC-Type")
    own = F.when(of_type == "response", F.col("bytes")).otherwise(F.lit(0)).cast("string")
    same = (
        header_value(header, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("sha1"))
    ) & (header_value(header, "Content-Length") == own)
    kind = F.when(F.coalesce(same, F.lit(False)), of_type).otherwise(
        F.raise_error(F.concat(F.lit("record without its payload "), F.col("digest")))
    )
    target = header_value(header, "WARC-Target-URI")
    for char, code in (("\n", "%0A"), ("\r", "%0D"), ("%", "%25")):
        target = F.replace(target, F.lit(code), F.lit(char))
    body = F.when(of_type == "response", F.col("payload")).otherwise(F.lit("").cast("binary"))
    return rows.select(
        "page_id", target.alias("url"), kind.alias("record_type"),
        F.regexp_extract(
            header_value(header, "WARC-Refers-To"), "<urn:page:(-?[0-9]+):[0-9]+>", 1
        ).try_cast("long").alias("refers_to"),
        F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "payload",
        F.concat("header", body, F.lit("\r\n\r\n").cast("binary")).alias("record"),
    )


def body_of(record: Column) -> Column:
    """The block of a record's bytes, cut out by what its header says."""
    text = F.substring_index(record.cast("string"), "\r\n\r\n", 1)
    length = header_value(F.concat(text, F.lit("\r\n")), "Content-Length").cast("int")
    return F.substring(record, F.octet_length(text) + 5, length)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to an archive in the shared folder and gives back what its records say, one row per page.

    Every record is put together again; length and digest of a response are those of the bytes found in its record, and
    a record whose bytes aren't its page's payload fails the job.
    """
    spark = pages.sparkSession
    records = read_records(spark, write_archive(pages)).withColumn("body", body_of(F.col("record")))
    response = F.col("record_type") == "response"
    right = F.when(response, F.col("body") == F.col("payload")).otherwise(F.octet_length("body") == 0)
    digest = F.when(response, base32_sha1(F.col("body"))).otherwise(F.col("payload_digest"))
    return records.select(
        "page_id", F.when(response, F.octet_length("body").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(F.coalesce(right, F.lit(False)), digest).otherwise(
            F.raise_error(F.lit("a record's bytes are not its payload"))
        ).alias("payload_digest"),
        "record_type", "refers_to",
    )
