"""One registered query per operator: it reads its whole table and shapes the operator's result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens import ship, tune
from bazaarlens.llm import language, oracle, quality
from bazaarlens.llm.alignment import aligned_tokens
from bazaarlens.llm.collocations import collocations
from bazaarlens.llm.decontamination import contamination
from bazaarlens.llm.extraction import extracted_texts
from bazaarlens.llm.minhash import near_duplicates
from bazaarlens.llm.neighbours import nearest_neighbours
from bazaarlens.llm.packing import packed_documents
from bazaarlens.llm.substrings import without_repeated_spans
from bazaarlens.llm.token_counts import token_counts
from bazaarlens.llm.url_filters import judged_pages
from bazaarlens.llm.warc import read_archive, write_archive
from bazaarlens.session import remove_at_exit, shared_folder

# Host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(tune(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    write_archive(pages, folder)
    return read_archive(spark, folder).select(
        F.expr("try_cast(page_id as bigint)").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_texts(_table(spark, sf_dir, "pages"))


def op4_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_repeated_spans(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", "text")


def op5_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packed_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judged_pages(_table(spark, sf_dir, "pages"), rules)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language.train(documents.where(~held_out))
    found = language.identified(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    result = quality.scored(documents.select("doc_id", "text", "n_chars"), quality.train(documents, labels))
    return result.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"), support=10, longest=3, top=2000, explained_percent=50)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    remove_at_exit(spark, cache)
    counted = token_counts(_table(spark, sf_dir, "documents"), cache, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return aligned_tokens(_table(spark, sf_dir, "documents"), a, b)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_warc_archive": op2_warc_archive,
    "op3_html_extraction": op3_html_extraction,
    "op4_sentence_span_dedup": op4_sentence_span_dedup,
    "op5_best_two_fit_packing": op5_best_two_fit_packing,
    "op6_url_filters": op6_url_filters,
    "op7_language_id": op7_language_id,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_minhash_near_dedup": oracle.NEAR_DUPLICATES,
    "op2_warc_archive": oracle.ARCHIVE,
    "op6_url_filters": oracle.URL_FILTERS,
    "op9_benchmark_decontamination": oracle.DECONTAMINATION,
    "op11_phrase_collocations": oracle.COLLOCATIONS,
}
