"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents.

A window is ``window`` consecutive words of an item (a shorter item is one window). It counts as
found where all its words stand in a document one after another, so all of its shingles must
occur, and any single one of them is a sufficient prefix: the rarest in all documents is taken.
Documents are joined to windows on that one token; the token's place in the window bounds where
the window may begin and end, and what is left is compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm import words as W
from bazaarlens.session import materialize

# Tokens looked up in one pass over the documents. A benchmark with more is taken in blocks, so
# what a task holds never grows with the benchmark.
TOKENS_PER_PASS = 1_000_000


def item_windows(benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """One row per window: item_id, window_id, its words, and the tokens of its shingles."""
    schema = "item_id string, window_id string, words array<string>, tokens array<long>"
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(partial(_windows, window, shingle), schema)


def _windows(window: int, shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        out: dict[str, list] = {"item_id": [], "window_id": [], "words": [], "tokens": []}
        for first, last, data, bounds in W.text_pieces(batch.column(1)):
            data = W.LOWER[data]
            starts, ends, rows = W.find_words(data, bounds, W.ALPHANUMERIC)
            hashes = W.hash_words(data, starts, ends)
            for row in range(last - first):
                a, b = rows[row], rows[row + 1]
                texts = [data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])]
                size = min(window, b - a)
                if size == 0:
                    continue
                tokens = W.as_longs(W.hash_runs(hashes[a:b], min(shingle, size)))
                per_window = size - min(shingle, size) + 1
                for start in range(b - a - size + 1):
                    out["item_id"].append(ids[first + row])
                    out["window_id"].append(f"{ids[first + row]}:{start}")
                    out["words"].append(texts[start : start + size])
                    out["tokens"].append(tokens[start : start + per_window])
        yield pa.RecordBatch.from_pydict(
            out,
            schema=pa.schema([
                ("item_id", pa.string()), ("window_id", pa.string()), ("words", pa.list_(pa.string())),
                ("tokens", pa.list_(pa.int64())),
            ]),
        )


def _token_places(data: np.ndarray, bounds: np.ndarray, lengths: list[int], table: np.ndarray):
    """Words of a piece, and (place of first word, token) of every run that is in the sorted table."""
    starts, ends, rows = W.find_words(data, bounds, W.ALPHANUMERIC)
    hashes = W.hash_words(data, starts, ends)
    places, tokens = [], []
    for length in lengths:
        runs = W.as_longs(W.hash_runs(hashes, length))
        found = np.searchsorted(table, runs)
        found[found == len(table)] = 0
        hit = np.flatnonzero(table[found] == runs)
        # A run must not leave the row it begins in.
        row = np.searchsorted(rows, hit, side="right") - 1
        hit = hit[hit + length <= rows[row + 1]]
        places.append(hit)
        tokens.append(runs[hit])
    return starts, ends, rows, np.concatenate(places), np.concatenate(tokens)


def _document_frequency(table: Broadcast, lengths: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(table.value), dtype=np.int64)
    for batch in batches:
        for _, _, data, bounds in W.text_pieces(batch.column(0)):
            _, _, rows, places, tokens = _token_places(W.LOWER[data], bounds, lengths, table.value)
            row = np.searchsorted(rows, places, side="right") - 1
            pairs = np.unique(np.stack([row, np.searchsorted(table.value, tokens)]), axis=1)
            np.add.at(counts, pairs[1], 1)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"token": table.value[seen], "documents": counts[seen]})


def _candidates(table: Broadcast, lengths: list[int], window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with its number of words and, for each token of the table in it, the words around."""
    hit_type = pa.struct([("token", pa.int64()), ("place", pa.int64()), ("lead", pa.int32()), ("around", pa.list_(pa.string()))])
    for batch in batches:
        counts, hits = [], []
        for first, last, data, bounds in W.text_pieces(batch.column(2)):
            data = W.LOWER[data]
            starts, ends, rows, places, tokens = _token_places(data, bounds, lengths, table.value)
            found: list[list] = [[] for _ in range(last - first)]
            for row, place, token in zip(np.searchsorted(rows, places, side="right") - 1, places, tokens):
                a = max(rows[row], place - window + 1)
                b = min(rows[row + 1], place + window)
                around = [data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b])]
                found[row].append({"token": token, "place": place - rows[row], "lead": place - a, "around": around})
            counts.extend(np.diff(rows).tolist())
            hits.extend(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(hit_type))],
            names=["doc_id", "text_hash", "n_words", "hits"],
        )


def _passes(tokens: DataFrame) -> list[Broadcast]:
    """Sorted tables of at most TOKENS_PER_PASS tokens or so that together hold all tokens."""
    spark = tokens.sparkSession
    parts = -(-tokens.count() // TOKENS_PER_PASS)
    tables = []
    for part in range(parts):
        rows = tokens.where(F.pmod(F.xxhash64("token"), F.lit(parts)) == part).toPandas()
        tables.append(spark.sparkContext.broadcast(np.sort(rows["token"].to_numpy(dtype=np.int64))))
    return tables


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (ids as strings, sorted), and what contaminates it.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. ``n_hit``
    counts the words inside any occurrence of any window. A null or empty text has no words and
    is clean; an item without words, or a null item id, contaminates nothing. A repeated row gives
    its result again. Very long texts are searched whole. Further columns of the inputs are ignored. Empty tables: no rows, or all clean.
    """
    return _judged(documents, benchmark, window, shingle).drop("text_hash")


def _judged(documents: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """What `contamination` gives, with the hash of the text that was judged."""
    windows = materialize(item_windows(benchmark, window, shingle).where(F.col("item_id").isNotNull()))
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    lengths = sorted(r[0] for r in windows.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())

    tokens = windows.select(F.explode("tokens").alias("token")).distinct()
    frequency = None
    for table in _passes(tokens):
        part = texts.select("text").mapInArrow(partial(_document_frequency, table, lengths), "token long, documents long")
        part = part.groupBy("token").agg(F.sum("documents").alias("documents"))
        frequency = part if frequency is None else frequency.unionByName(part)
    if frequency is None:
        frequency = tokens.select("token", F.lit(0).cast("long").alias("documents"))

    # The rarest token of each window; a window with a token that no document has is left out.
    ranked = (
        windows.select("item_id", "window_id", "words", F.size("tokens").alias("n_tokens"), F.posexplode("tokens").alias("lead", "token"))
        .join(frequency, "token")
        .groupBy("window_id", "item_id", "words", "n_tokens")
        .agg(F.min(F.struct("documents", "token", "lead")).alias("prefix"), F.count("*").alias("found"))
        .where("found = n_tokens")
    )
    prefixes = materialize(ranked.select("item_id", "words", F.col("prefix.token").alias("token"), F.col("prefix.lead").alias("offset")))

    found = None
    tables = _passes(prefixes.select("token").distinct()) or [
        documents.sparkSession.sparkContext.broadcast(np.array([0], dtype=np.int64))
    ]
    for table in tables:
        part = texts.mapInArrow(
            partial(_candidates, table, lengths or [shingle], window),
            "doc_id " + dict(texts.dtypes)["doc_id"] + ", text_hash long, n_words long, "
            "hits array<struct<token:long,place:long,lead:int,around:array<string>>>",
        )
        found = part if found is None else found.unionByName(part)
    found = materialize(found)

    candidates = found.select("doc_id", "text_hash", F.explode("hits").alias("hit")).select("doc_id", "text_hash", "hit.*")
    begin = F.col("lead") - F.col("offset")
    verified = (
        candidates.join(prefixes, "token")
        # The window must begin and end inside the document, and all its words must be there.
        .where((begin >= 0) & (begin + F.size("words") <= F.size("around")))
        .where(F.slice("around", begin + 1, F.size("words")) == F.col("words"))
        .select("doc_id", "text_hash", "item_id", (F.col("place") - F.col("offset")).alias("start"), F.size("words").alias("length"))
    )
    per_document = verified.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.collect_set(F.struct("start", "length")).alias("spans"),
    )
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    per_document = per_document.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "items", F.size(places).cast("long").alias("n_hit")
    )
    base = found.select("doc_id", "text_hash", "n_words")
    if len(tables) > 1:  # every pass gives every document
        base = base.groupBy("doc_id", "text_hash", "n_words").agg((F.count("*") / len(tables)).cast("int").alias("times"))
        base = base.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return base.join(per_document, same, "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no window of the benchmark occurs; null ids are kept."""
    hit = contamination(documents, benchmark, window).where("contaminated").select("doc_id").distinct()
    return documents.join(hit, "doc_id", "left_anti")


def clean_texts(documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """The rows whose own text holds no window of the benchmark, whatever their ids and other rows'."""
    hit = _judged(documents, benchmark, window, shingle).where("contaminated").select("doc_id", "text_hash").distinct()
    hit = hit.select(F.col("doc_id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash"))
    same = documents["doc_id"].eqNullSafe(F.col("_hit_id")) & (F.xxhash64(documents["text"]) == F.col("_hit_hash"))
    return documents.join(hit, same, "left_anti")
