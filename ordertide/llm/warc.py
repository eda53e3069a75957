"""Content-addressed WARC archive.

``write_archive`` stores every payload once, under its SHA-256 digest, and beside
it the exact header bytes of every record: of records with equal payloads the one
with the smallest id is the response, the others are revisits that refer to it.
``read_archive`` joins headers and payloads, verifies digest and length of every
payload, and gives the original records back, byte for byte.

Payloads below ``min_payload`` bytes are never shared: each of their records is a
response. Null payloads are empty, null URLs leave their header line out. In headers
ids are URL-encoded, so that any text can be one. Record ids are expected to be unique; copies of one id are records of their own, and rows
with a null id are kept and sort after all others as candidates for the response.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ordertide.llm.common import quoted
from ordertide.sources.scratch import shared_folder

# Digits of RFC 4648 base 32 and of numbers to base 32.
BASE32, DIGITS32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
EPOCH = "1970-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: 160 bits as four numbers of eight digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def _header(date: str) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def record(of: Column) -> Column:
        return F.concat(F.lit("<urn:record:"), F.url_encode(of.cast("string")), F.lit(">"))

    missing = F.lit("")
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record(F.coalesce(F.col("id").cast("string"), F.lit("none")))),
        F.when(F.col("url").isNull(), missing).otherwise(line(
            "WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " "))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(F.col("refers_to").isNull(), missing).otherwise(
            line("WARC-Refers-To", record(F.col("refers_to")))),
        line("Content-Length", F.col("content_length").cast("string")), F.lit("\r\n"))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_payload: int = 0, date: str = EPOCH) -> None:
    """Write ``folder``/payloads and ``folder``/headers.

    Only the payload travels with its digest, once, combined before the shuffle;
    the headers are made from ids, digests and lengths.
    """
    bytes_of = F.coalesce(quoted(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(quoted(id_col).alias("id"), quoted(url_col).cast("string").alias("url"),
                        bytes_of.alias("payload"))
    addressed = rows.withColumn("address", F.sha2("payload", 256))
    addressed.groupBy("address").agg(F.first("payload").alias("payload")).write.parquet(
        f"{folder}/payloads")

    records = addressed.select(
        "id", "url", "address", sha1_base32(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"))
    first = records.groupBy("address").agg(F.min("id").alias("first_id"))
    shared = F.col("payload_bytes") >= min_payload
    revisit = shared & F.coalesce(F.col("id") != F.col("first_id"), F.col("first_id").isNotNull())
    full = records.join(first, "address").select(
        "id", "url", "address", "payload_digest", "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).alias("content_length"))
    full.select("id", "address", _header(date).cast("binary").alias("header")).write.parquet(
        f"{folder}/headers")


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Columns id, header, payload and record of all records.

    ``record`` is the exact WARC record: header, the content of its block (empty
    for revisits), two line ends. A payload that is missing, or whose bytes do not
    have the address it is stored under, or the digest and length its header
    states, raises an error.
    """
    headers, payloads = (spark.read.parquet(f"{folder}/{t}") for t in ("headers", "payloads"))
    sound = payloads.select("address", F.when(
        F.sha2("payload", 256) == F.col("address"), F.col("payload")).alias("payload"))
    both = headers.join(sound, "address", "left")
    length = F.coalesce(F.octet_length("payload"), F.lit(-1)).cast("string")
    block = F.when(_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    stated = (_field("Content-Length") == F.octet_length(block).cast("string")) & (
        _field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), sha1_base32(F.col("payload"))))
    broken = F.concat(F.lit("payload does not verify: "), F.col("address"), F.lit(" "), length)
    payload = F.when(F.coalesce(stated, F.lit(False)), F.col("payload")).otherwise(
        F.raise_error(broken).cast("binary"))
    return both.select("id", "header", payload.alias("payload"), block.alias("block")).select(
        "id", "header", "payload",
        F.concat(F.col("header"), F.col("block"), F.lit(b"\r\n\r\n")).alias("record"))


def new_archive(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"


def describe(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """What the headers and payloads read back say of each record, and a digest of the whole record."""
    refers = F.url_decode(F.regexp_extract(_field("WARC-Refers-To"), "<urn:record:(.*)>", 1))
    kind = records.schema["id"].dataType
    return records.select(
        F.col("id").alias(id_col), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _field("WARC-Type").alias("record_type"), refers.cast(kind).alias("refers_to"),
        F.sha2("record", 256).alias("record_sha256"))
