"""A content-addressed web archive.

Three steps, all DataFrame operations. Every page gets a record: exact header bytes, stored with
the strong digest (SHA-256) of its payload. Payloads are stored once per digest. Reading joins
the two: each stored payload is hashed again, and a digest that does not match raises an error
instead of a wrong record.

Of pages with equal payloads the smallest page_id (null last, then the row stored first) is the
response; the others are revisits that refer to it. Payloads under min_payload bytes are always
responses of their own, though stored once as well. Only digests and ids are grouped, so a
payload shared by a third of all pages costs one stored copy and many small rows.

Defined cases: null html is an empty payload; null url an empty header value; a repeated page_id
gives a record per row; line ends in a url are percent-encoded, so that a header can't be forged;
an empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystone.llm.common import read, stage
from tallystone.sources.files import scratch_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
MIN_PAYLOAD = 0
WARC_DATE = "2024-01-01T00:00:00Z"


def base32_of_hex(name: str) -> Column:
    """Base32 of a 160-bit digest given in hex: five hex digits make four letters."""
    return F.expr(
        f"""array_join(transform(sequence(0, 31), i -> substr('{BASE32}',
            1 + (shiftright(cast(conv(substr({name}, 1 + (i div 4) * 5, 5), 16, 10) as int), 15 - 5 * (i % 4)) & 31), 1)), '')"""
    )


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, min_payload: int = MIN_PAYLOAD, date: str = WARC_DATE) -> None:
    """Write path/headers (one row per page) and path/payloads (one row per distinct payload)."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = pages.select(
        "page_id",
        F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("rid"),
    )
    facts = stage(facts.withColumn("sha1", base32_of_hex("sha1")), "warc-facts")
    order = F.struct(F.col("page_id").isNull().alias("without"), "page_id", "rid")
    # Stored, so that the join has two plain shuffles and Spark can split the one of a large group.
    first = stage(facts.groupBy("digest").agg(F.min(order).alias("first")), "warc-first")
    joined = facts.join(first, "digest")
    revisit = (F.col("bytes") >= min_payload) & (F.col("first.rid") != F.col("rid"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_field("WARC-Refers-To", _record_id(F.col("first.page_id"))), _field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        _field("Content-Type", F.lit("text/html")),
        _field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    joined.select(F.col("rid").alias("record"), header.cast("binary").alias("header"), "digest").write.parquet(f"{path}/headers")
    # Local limits run before the shuffle, so copies in one partition are dropped there.
    once = Window.partitionBy("digest").orderBy("page_id")
    stored = pages.select("page_id", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    stored.withColumn("n", F.row_number().over(once)).where("n = 1").select("digest", "payload").write.parquet(f"{path}/payloads")


def _archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    headers = spark.read.schema("record long, header binary, digest string").parquet(f"{path}/headers")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("stored payload does not match its digest "), F.col("digest")))
    return headers, payloads.withColumn("digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(wrong))


def read_archive(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """A row per record, from its header and its stored payload; page ids are read as the type they had."""
    headers, payloads = _archive(spark, path)
    facts = payloads.select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("sha1"))
    facts = facts.withColumn("payload_digest", base32_of_hex("sha1")).drop("sha1")
    text = F.col("header").cast("string")

    def value(name: str, pattern: str) -> Column:
        found = F.regexp_extract(text, rf"\r\n{name}: {pattern}\r\n", 1)
        return F.when(found != "", found)

    same = F.col("payload_digest") == F.col("written")
    return (
        headers.select(
            "digest",
            value("WARC-Record-ID", r"<urn:page:([^>\r\n]*)>").cast(id_type).alias("page_id"),
            value("WARC-Type", "([a-z]+)").alias("record_type"),
            value("WARC-Refers-To", r"<urn:page:([^>\r\n]*)>").cast(id_type).alias("refers_to"),
            value("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("written"),
        )
        .join(facts, "digest")
        .select(
            "page_id",
            "payload_bytes",
            F.when(same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a header's payload digest is not that of the stored payload"))).alias("payload_digest"),
            "record_type",
            "refers_to",
        )
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Whole records (record, bytes), each with its full payload, as first written."""
    headers, payloads = _archive(spark, path)
    end = F.lit("\r\n\r\n").cast("binary")
    return headers.join(payloads, "digest").select("record", "header", "payload", F.concat("header", "payload", end).alias("bytes"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(read(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read_archive(spark, path)


OP3_SQL = rf"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages),
r AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY page_id) AS n, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('{BASE32}', 1 + (((('0x' || substr(h, 1 + (i // 4) * 5, 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 THEN first_id END AS refers_to
FROM r
"""
