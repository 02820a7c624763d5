"""Content-addressed web archive.

Two tables in one folder: ``payloads`` holds each distinct payload once under its SHA-256, ``records`` holds the exact
header bytes of every record. Records are rebuilt by a join on the digest. A digest is trusted only after checks: when writing, all payloads of
one digest must agree in length and in two further hashes; when reading, the stored bytes must have their digest again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagegrain.llm.common import table, written
from pagegrain.session import scratch_path

#: Record date where the pages carry none.
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def base32(binary: Column) -> Column:
    """RFC 4648 of 20 bytes: 5 hexadecimal digits are 4 base-32 digits."""
    digits = F.hex(binary)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1(payload: Column) -> Column:
    return base32(F.unhex(F.sha1(payload)))


def record_name(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """One record per row of ``pages`` (``page_id``, ``url``, ``html``).

    Of rows with equal payloads of ``least_bytes`` or more, the smallest ``page_id`` is a response, the others revisit
    it; smaller payloads are all responses. A null html is an empty payload, a null url an empty target. Rows that repeat the
    smallest id are responses too. Rows without id revisit their group's smallest id, or are responses where the group has none.
    Other columns are left out.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    digest = F.sha2("payload", 256)
    seen = written(rows.select("page_id", "url", digest.alias("digest"), sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("bytes"),
                               F.xxhash64("payload").alias("check1"), F.crc32("payload").alias("check2")), "seen")
    agreed = (F.min("bytes") == F.max("bytes")) & (F.min("check1") == F.max("check1")) & (F.min("check2") == F.max("check2"))
    firsts = seen.groupBy("digest").agg(F.min("page_id").alias("first"), agreed.alias("agreed")).select(
        "digest", F.when(F.col("agreed"), F.col("first")).otherwise(F.raise_error(F.concat(F.lit("different payloads have the digest "), F.col("digest")))).alias("first"))
    revisit = (F.col("bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    target = F.col("url")
    # line ends would end the header field
    target = F.regexp_replace(target, "[\r\n]", "")
    lines = F.concat(
        F.lit("WARC/1.1"), F.lit(END), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(END),
        F.lit("WARC-Record-ID: "), record_name(F.col("page_id")), F.lit(END), F.lit("WARC-Target-URI: "), target, F.lit(END),
        F.lit(f"WARC-Date: {DATE}{END}"), F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1"), F.lit(END),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{END}WARC-Refers-To: "), record_name(F.col("first")), F.lit(END))).otherwise(""),
        F.lit("Content-Type: text/html"), F.lit(END), F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("bytes")), F.lit(END + END))
    # the hot digest's rows are narrow, and its other side is one row: AQE may split them
    seen.join(firsts, "digest").select(F.col("digest"), lines.cast("binary").alias("header")).write.parquet(f"{path}/records")
    # equal payloads meet inside the tasks first: one copy per task is moved
    rows.groupBy(digest.alias("digest")).agg(F.min("payload").alias("payload")).write.parquet(f"{path}/payloads")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``digest`` and verified ``payload``."""
    rows = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    whole = F.sha2("payload", 256) == F.col("digest")
    return rows.select("digest", F.when(whole, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))).alias("payload"))


def field(name: str) -> Column:
    return F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)", 1)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``digest``, ``header`` and its parsed fields."""
    def page(column: Column) -> Column:
        return F.nullif(F.regexp_extract(column, "<urn:page:(-?[0-9]+)>", 1), F.lit("")).cast("long")

    rows = spark.read.schema("digest string, header binary").parquet(f"{path}/records")
    return rows.select("digest", "header", page(field("WARC-Record-ID")).alias("page_id"), field("WARC-Target-URI").alias("url"),
                       field("WARC-Type").alias("record_type"), page(field("WARC-Refers-To")).alias("refers_to"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Headers with ``payload`` and the exact ``record`` bytes (a revisit has no block of its own)."""
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return (read_headers(spark, path).join(read_payloads(spark, path), "digest")
            .withColumn("record", F.concat("header", block, F.lit(b"\r\n\r\n"))))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    # measured on the stored bytes once, joined to every record that has them
    measured = read_payloads(spark, path).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"), sha1(F.col("payload")).alias("payload_digest"))
    return read_headers(spark, path).join(measured, "digest").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = r"""
WITH RECURSIVE p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), h AS (
  SELECT page_id, html, octet_length(encode(html)) AS payload_bytes, sha1(encode(html)) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p
), d AS (
  SELECT *, list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)) AS letters FROM h
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(letters, '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""
