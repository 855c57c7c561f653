"""Token counts through a cache of digests.

The cache is a folder of Parquet tables, one folder per tokenizer version (a digest of library, its version
and file), of (content, n_tokens), where content is the SHA-256 of a normalised text: UTF-8, null as
the empty text, nothing else changed, as any other change could change the count. Digests of the
documents are joined to it; of those not found, one text each is encoded, and their counts are appended as a
further table. Appended tables are never changed, so runs may share a cache, and a run that dies leaves
no wrong row behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.tokens import tokenizer, version_digest
from bazaarlens.session import materialize, release

_CACHE_ROWS = "content binary, n_tokens long"
# Characters that are encoded at a time, about; a longer text is encoded alone.
CHARS_AT_ONCE = 1 << 20


def _cached(spark: SparkSession, folder: str) -> DataFrame:
    """One row per digest of a version's folder; none if there is no folder yet."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], _CACHE_ROWS)
    # Runs at the same time may have appended the same text.
    rows = spark.read.schema(_CACHE_ROWS).parquet(f"{folder}/*")
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(tokenizer_file: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = tokenizer(tokenizer_file)
    for batch in batches:
        texts, counts, at = batch.column(1), [], 0
        held: list[str] = []
        chars = 0
        for at in range(len(texts)):
            held.append(texts[at].as_py())
            chars += len(held[-1])
            if chars >= CHARS_AT_ONCE or at == len(texts) - 1:
                counts += map(len, model.encoded(held))
                held, chars = [], 0
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])


def token_counts(documents: DataFrame, cache: str, tokenizer_file: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document, and its text's digest as ``content``; ``cache`` is filled up.

    Counts are those of the tokenizer's own library for the whole text, without any added tokens. ``documents``
    needs doc_id and text; further columns are ignored, whatever their names. Null texts are empty
    ones; a null doc_id stays null; each row is a document, also a repeated one, but equal texts are
    encoded once. Very long texts are encoded in parts between words, where the tokenizer allows that. An empty table
    gives no rows and leaves the cache as it is.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = materialize(documents.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), content.alias("content")))
    folder = f"{cache}/{version_digest(tokenizer_file)}"

    wanted = rows.select("content").distinct()
    misses = materialize(wanted.join(_cached(spark, folder), "content", "left_anti"))
    if not misses.isEmpty():
        texts = documents.select(content.alias("content"), text.alias("text"))
        # Copies go before texts are shuffled. Where Spark can broadcast the misses, it asks for them before that, and
        # texts that are known stay where they are.
        texts = texts.dropDuplicates(["content"]).join(misses, "content", "left_semi")
        encoded = texts.mapInArrow(partial(_encode, tokenizer_file), _CACHE_ROWS)
        encoded.write.parquet(f"{folder}/{uuid.uuid4().hex}")
    known = materialize(rows.select("content").distinct().join(_cached(spark, folder), "content"))
    release(misses)
    # Both sides are stored and dealt by content alone, so a text that very many rows have is split.
    return rows.join(known, "content").select("doc_id", "n_bytes", "n_tokens", "content")
