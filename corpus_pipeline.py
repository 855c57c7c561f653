"""A corpus run: every stage reads what its predecessor kept and writes what it keeps."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens import ship, tune
from bazaarlens.llm import quality
from bazaarlens.llm.decontamination import clean_texts
from bazaarlens.llm.minhash import one_row_of_each_group
from bazaarlens.llm.packing import packed_documents
from bazaarlens.llm.substrings import without_repeated_spans
from bazaarlens.session import remove_at_exit, remove_folder, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents that score lower are rejected.
LEAST_QUALITY = 0.3


def _set_apart(docs: DataFrame, *names: str) -> DataFrame:
    """The documents with columns of these names called something else, so that a stage may use the names."""
    return docs.withColumnsRenamed({name: _OWN + name for name in names if name in docs.columns})


def _as_before(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, in their order and under their names."""
    there = set(result.columns)
    return result.select(*[F.col(f"`{_OWN + c if _OWN + c in there else c}`").alias(c) for c in docs.columns])


_OWN = "_own_"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, does not reject.

    Null and empty texts are judged by structure and metadata, very long ones whole; each row is judged on its
    own, so repeated ones go or stay together, and a score of exactly LEAST_QUALITY stays. Without labels nothing goes. An
    empty table stays empty. Columns named score and all others keep their values.
    """
    labels = ship(tune(spark)).read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    scored = quality.scored(_set_apart(docs, "score"), quality.train(docs, labels))
    return _as_before(scored.where(F.col("score") >= LEAST_QUALITY), docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; rows without id take part.

    Of repeated rows one stays. Null, empty and blank texts all stay, very long ones are compared whole. An
    empty table stays empty. All columns keep their values, whatever their names.
    """
    ship(tune(spark))
    return one_row_of_each_group(docs)


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what stands elsewhere already; a document of which nothing is left goes.

    Of equal passages that with the smallest doc_id stays, without id last; rows that repeat id and text keep the same
    words. Null and empty texts stay as they are, very long ones are searched whole. An empty table stays empty. n_chars
    follows the text where it changes, all other columns keep their values, whatever their names.
    """
    ship(tune(spark))
    cleaned = without_repeated_spans(_set_apart(docs, "n_words", "n_removed"))
    emptied = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_words"))
    cleaned = cleaned.where(~emptied)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return _as_before(cleaned, docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark.

    Each row is judged by its own text, whatever its id and other rows'. Null and empty texts stay, very long ones are
    searched whole; an empty benchmark removes nothing, an empty table stays empty. All columns keep their values.
    """
    return clean_texts(docs, ship(tune(spark)).read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their token ids and places in sequences.

    Null and empty texts are packed with their end id, long ones in pieces; each row is packed, repeated ones too.
    Further columns are left out. An empty table gives no rows.
    """
    ship(tune(spark))
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("minhash_near_dedup", keep_one_of_near_duplicates),
    ("substring_dedup", remove_repeated_spans),
    ("benchmark_decontamination", remove_benchmark_leaks),
    ("best_fit_packing", pack),
]

# A trained model is no SQL, and packing may give any numbers to its sequences.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each one's rows are written as Parquet and read again.

    What a stage wrote goes when the next one has written; the last one's rows go with the driver.
    """
    docs = ship(tune(spark)).read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return docs
