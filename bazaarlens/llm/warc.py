"""Content-addressed web archive: payloads once by digest, record headers beside them.

An archive is a folder of two Parquet tables. ``payloads`` holds the bytes of each distinct payload
once, under the SHA-256 of its bytes; ``headers`` holds the exact header bytes of every WARC record
with the digest it refers to. Records are put together again by a join on the digest, and the bytes
that come out are hashed again: a payload that does not have its digest stops the job.

DataFrame functions only. The first page of each payload is found by an aggregation and
handed out by a join with one row per repeated digest, so copies of one payload spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.session import materialize, release

# Shorter payloads are never replaced by a reference.
LEAST_REVISIT_BYTES = 100
_NAME = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """One header line, or null for a null value; line breaks in a value are percent-encoded."""
    value = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), value)


def _field(name: str) -> Column:
    """A header line's value, or null where the record has no such line."""
    found = F.regexp_extract(F.col("header").cast("string"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.length(found) > 0, found)


def write_archive(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one WARC record per row of ``pages`` (page_id, url, html).

    The payload is html in UTF-8, nothing if null. Of pages with equal payloads of at least
    100 bytes that with the smallest page_id is the response (also each row that repeats it) and the
    others revisit it. A page without page_id is always a response; a null url gives no target line. Further columns are ignored. An empty table gives an archive without records.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("digest"))

    slim = rows.select("page_id", "url", "digest", F.octet_length("payload").alias("size"))
    # Only payloads that repeat, and stored: adaptive splitting then spreads the copies of one.
    first = slim.groupBy("digest").agg(F.min("page_id").alias("first_page"), F.count("*").alias("copies"))
    first = materialize(first.where("copies > 1").drop("copies"))
    revisit = (F.col("size") >= LEAST_REVISIT_BYTES) & (F.col("page_id") > F.col("first_page"))
    revisit = F.coalesce(revisit, F.lit(False))
    name = F.concat(F.lit(f"<{_NAME}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", name),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Refers-To", F.concat(F.lit(f"<{_NAME}"), F.col("first_page").cast("string"), F.lit(">")))),
        F.when(revisit, _line("WARC-Profile", F.lit(_PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size"))),
    )
    headers = slim.join(first, "digest", "left").select("digest", F.concat(lines, F.lit("\r\n\r\n")).cast("binary").alias("header"))
    headers.write.option("compression", "zstd").parquet(f"{folder}/headers")
    release(first)
    # Copies are dropped by each task before the bytes are shuffled.
    rows.groupBy("digest").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(
        f"{folder}/payloads"
    )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record: header and payload as they were, and what the header says.

    Columns: header, payload (of a revisit that of the record it refers to), page_id, url,
    record_type, payload_digest (hex), refers_to.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads").withColumnRenamed("digest", "stored")
    wrong = F.raise_error(F.concat(F.lit("no payload has the digest "), F.col("digest")))
    right = F.col("payload").isNotNull() & (F.sha2("payload", 256) == F.col("digest"))
    records = headers.join(payloads, F.col("digest") == F.col("stored"), "left")
    records = records.select("header", F.when(right, F.col("payload")).otherwise(wrong.cast("binary")).alias("payload"))
    return records.select(
        "header",
        "payload",
        F.regexp_extract(_field("WARC-Record-ID"), rf"^<{_NAME}(.+)>$", 1).alias("page_id"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"),
        F.replace(_field("WARC-Payload-Digest"), F.lit("sha256:"), F.lit("")).alias("payload_digest"),
        F.regexp_extract(_field("WARC-Refers-To"), rf"^<{_NAME}(.+)>$", 1).alias("refers_to"),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """The exact bytes of each record, as a WARC file holds them: a revisit has no block."""
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.withColumn("record", F.concat("header", block, F.lit(b"\r\n\r\n")))
