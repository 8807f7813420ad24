"""Content-addressed WARC archive.

``write_archive`` stores every payload once under its SHA-256, keeps the exact header bytes of every
record in a table of their own, and ``read_archive`` / ``reconstruct`` join the two back. Nothing but
DataFrame expressions runs here.

Cases: a null payload is the empty payload; a null url gives an empty target URI; rows with an equal id
and payload are separate records, of which exactly one (the first by id, then by storage order) is the
response; null ids sort after all others; an empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.llm.common import stored

# Digits of base 32 as conv() writes them and as RFC 4648 has them.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
RECORDS_SCHEMA = T.StructType([
    T.StructField("record_no", T.LongType()), T.StructField("page_id", T.LongType()),
    T.StructField("digest", T.StringType()), T.StructField("header", T.BinaryType()),
])
PAYLOADS_SCHEMA = T.StructType([T.StructField("digest", T.StringType()), T.StructField("payload", T.BinaryType())])


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column (160 bits, so no padding)."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), CONV_DIGITS, RFC_DIGITS)


def header_block(page_id: Column, url: Column, length: Column, sha1: Column, refers_to: Column, date: str) -> Column:
    """Header bytes of a record; a revisit names the record that it refers to."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    uri = F.regexp_replace(text(url), "[\\r\\n]+", " ")
    block = F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "), F.when(refers_to.isNull(), "response").otherwise("revisit"),
        F.lit(CRLF + "WARC-Record-ID: <urn:page:"), text(page_id), F.lit(">" + CRLF + "WARC-Date: " + date + CRLF + "WARC-Target-URI: "), uri,
        F.lit(CRLF + "WARC-Payload-Digest: sha1:"), sha1,
        F.when(refers_to.isNull(), F.lit("")).otherwise(F.concat(F.lit(CRLF + "WARC-Refers-To: <urn:page:"), refers_to, F.lit(">"))),
        F.lit(CRLF + "Content-Type: text/html" + CRLF + "Content-Length: "), length.cast("string"), F.lit(CRLF + CRLF))
    return F.encode(block, "UTF-8")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                  id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write ``<path>/records`` (headers) and ``<path>/payloads`` (each payload once).

    Records whose payload of at least ``min_bytes`` bytes was seen under a smaller id become revisits; only
    narrow rows (id, url, digests) are shuffled for that. Payloads meet by digest after a map-side reduction.
    """
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    digested = src.withColumn("digest", F.sha2("payload", 256))
    narrow = stored(digested.select(
        F.monotonically_increasing_id().alias("record_no"), "page_id", "url", "digest",
        F.octet_length("payload").cast("long").alias("length"), base32_sha1(F.col("payload")).alias("sha1")), "warc-index")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_no")
    first = stored(narrow.groupBy("digest").agg(
        F.min(order).alias("first"),
        # equal SHA-256 must mean equal bytes: a second digest and the length have to agree
        F.when((F.min("sha1") == F.max("sha1")) & (F.min("length") == F.max("length")), True)
        .otherwise(F.raise_error(F.lit("different payloads under one SHA-256"))).alias("verified")), "warc-first")
    joined = narrow.join(first, "digest").where("verified")
    repeat = (F.col("length") >= min_bytes) & (F.col("first.record_no") != F.col("record_no"))
    refers = F.when(repeat, F.coalesce(F.col("first.page_id").cast("string"), F.lit("")))
    joined.select("record_no", "page_id", "digest",
                  header_block(F.col("page_id"), F.col("url"), F.col("length"), F.col("sha1"), refers, date).alias("header")
                  ).write.parquet(f"{path}/records")
    digested.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")


def archive_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (spark.read.schema(RECORDS_SCHEMA).parquet(f"{path}/records"),
            spark.read.schema(PAYLOADS_SCHEMA).parquet(f"{path}/payloads"))


def _verified(payloads: DataFrame) -> DataFrame:
    """Stored payloads whose bytes still have the digest that they are stored under."""
    ok = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload damaged: "), F.col("digest"))).cast("binary"))
    return payloads.select("digest", ok.alias("payload"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, from the stored headers and the stored bytes of its payload.

    Lengths and digests are taken once per stored payload, before the join, so the join moves no payload.
    """
    records, payloads = archive_tables(spark, path)
    sums = _verified(payloads).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                      base32_sha1(F.col("payload")).alias("payload_digest"))
    head = F.decode("header", "UTF-8")
    refers = F.regexp_extract(head, r"\r\nWARC-Refers-To: <urn:page:([^>]*)>", 1)
    parsed = records.select(
        "record_no", "page_id", "digest", F.regexp_extract(head, r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)", 1).alias("claimed"),
        F.regexp_extract(head, r"^WARC/[0-9.]+\r\nWARC-Type: ([a-z]+)", 1).alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"))
    ok = F.when(F.col("claimed") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
        F.raise_error(F.lit("a record's digest differs from its payload's")).cast("string"))
    return parsed.join(sums, "digest").select("page_id", "payload_bytes", ok.alias("payload_digest"), "record_type", "refers_to")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``(record_no, page_id, record)``: the full record bytes, header + payload + the two closing line ends."""
    records, payloads = archive_tables(spark, path)
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    return records.join(_verified(payloads), "digest").select(
        "record_no", "page_id", F.concat("header", "payload", end).alias("record"))
