"""A content-addressed archive of WARC records: payload bytes once by strong digest, record headers apart, records put together by joins.

``write_archive`` makes two tables in a folder. ``payloads`` holds each distinct payload once under its SHA-256, checked on the way in: all
records that share a SHA-256 must agree in length and SHA-1. ``headers`` holds each record's exact header bytes (WARC 1.1 header and HTTP header
block) and the SHA-256 of its payload. ``read_archive`` checks every stored payload against its key and its records' stated digests and
gives what the headers say; ``restore`` gives the original records, byte for byte.

Payloads are put under their digest by an aggregate that keeps one in each task before it shuffles, so a payload that a third of all records
share travels once a task. Records meet what is known of their payloads by ``hot.join_by_weight``.

Of the records of one payload with at least ``least_bytes`` bytes, that with the largest id is the response and the others revisit it; of rows that repeat the largest
id, each is a response. Smaller payloads are all responses. A null payload is an empty one. A null id comes before all others; where a group
has no other, all its records are responses. A null url leaves its line out; line ends in a url are written as %0D and %0A. Only the id, url
and payload columns are read, so other columns may have any names. An empty table makes an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.hot import join_by_weight
from quarterdeck.session import materialize

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: base 32 of RFC 4648
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture
END = "\r\n"


def base32(hexed: Column) -> Column:
    """Base 32 of 20 bytes given in hex: four lots of 40 bits, eight letters each."""
    lots = [F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 10).cast("long") for k in range(4)]
    return F.concat(*[F.substr(F.lit(ALPHABET), (F.shiftright(lot, 35 - 5 * j).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for lot in lots for j in range(8)])


def _urn(value: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(value.cast("string"), F.lit("")), F.lit(">"))


def _header(date: str) -> Column:
    """The bytes before a record's payload."""
    revisit = F.col("refers").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END + END))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1"))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("refers")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(END, *lines), F.lit(END + END), http).cast("binary")


def write_archive(pages: DataFrame, folder: str, payload: str = "html", page_id: str = "page_id", url: str = "url", least_bytes: int = 0, date: str = DATE) -> None:
    """Write the records of ``pages``, a row each, as an archive in ``folder``."""
    raw = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), raw.alias("payload"))
    hashed = rows.withColumns({"sha256": F.unhex(F.sha2("payload", 256)), "sha1": F.upper(F.sha1("payload")), "bytes": F.octet_length("payload").cast("long")})
    facts = F.struct("bytes", "sha1")
    stored = hashed.groupBy("sha256").agg(F.max("id").alias("last"), F.count("*").alias("records"), F.min(facts).alias("low"), F.max(facts).alias("high"), F.first("payload").alias("payload"))
    checked = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(F.raise_error(F.lit("two payloads share a SHA-256")))
    stored.select("sha256", "last", "records", checked.alias("payload")).write.parquet(f"{folder}/payloads")
    slim = materialize(hashed.select("id", "url", "sha256", "sha1", "bytes"), "records")
    known = pages.sparkSession.read.parquet(f"{folder}/payloads").select("sha256", "last", "records")
    refers = F.when((F.col("bytes") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("last")), F.col("last"))
    records = join_by_weight(slim, known, "sha256", "records").withColumn("refers", refers)
    records.select("id", "sha256", _header(date).alias("header")).write.parquet(f"{folder}/headers")


def _said(name: str, value: str) -> Column:
    """A header line's value, null without the line. Only the WARC header is looked at, where every line stands alone."""
    found = F.regexp_extract(F.col("header").cast("string"), rf"^(?:[^\r]+\r\n)+?{name}: {value}\r\n", 1)
    return F.when(found != "", found)


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Stored payloads, each checked against its key."""
    stored = spark.read.parquet(f"{folder}/payloads")
    good = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    return stored.withColumn("payload", F.when(good, F.col("payload")).otherwise(F.raise_error(F.lit("a stored payload is not what its digest says"))))


def read_archive(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every record, from its header and the stored payload."""
    found = _payloads(spark, folder).select("sha256", "records", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.upper(F.sha1("payload"))).alias("payload_digest"))
    headers = spark.read.parquet(f"{folder}/headers").select("sha256", "header")
    met = join_by_weight(headers, materialize(found, "payload_facts"), "sha256", "records")
    digest = F.when(_said("WARC-Payload-Digest", "sha1:([A-Z2-7]+)") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header states another digest")))
    return met.select(
        _said("WARC-Record-ID", "<urn:page:([^>]+)>").cast(id_type).alias("page_id"),
        "payload_bytes",
        digest.alias("payload_digest"),
        _said("WARC-Type", "([a-z]+)").alias("record_type"),
        _said("WARC-Refers-To", "<urn:page:([^>]+)>").cast(id_type).alias("refers_to"),
    )


def restore(spark: SparkSession, folder: str) -> DataFrame:
    """``id, record`` (whole bytes as they stand in a WARC file, ended by two line ends), ``payload`` (of revisits too, from the record they refer to)."""
    stored = _payloads(spark, folder).select("sha256", "records", "payload")
    met = join_by_weight(spark.read.parquet(f"{folder}/headers"), stored, "sha256", "records")
    body = F.when(_said("WARC-Type", "([a-z]+)") == "response", F.col("payload")).otherwise(F.lit(b""))
    return met.select("id", F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"), "payload")
