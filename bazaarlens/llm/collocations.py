"""Phrase collocations by partitioning (SON).

Documents are dealt to ``shards`` by a hash. A phrase with at least ``support`` occurrences has at
least ``support / shards`` of them in one shard, whatever their sizes. So each shard is mined completely
at that lower support: words and pairs of them first, then level by level; a phrase of k words is looked at only where
both phrases of k - 1 words in it are frequent in the shard. The phrases frequent in any shard are the candidates, and
a last pass counts them all over the whole corpus, as words and not as hashes.

A shard is no task: its counts are shuffled like all others, so a corpus of any size has the same few
shards. What is frequent reaches the tasks as a bit table of at most 128 MB (see `bits`). Where two
phrases share a bit, one is looked at in vain; none is ever missed.

Not all that is frequent in some shard is counted again: its numbers there, and the most it can have in the
other shards without being frequent in them, must reach ``support`` together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm import words as W
from bazaarlens.llm.bits import bit_table
from bazaarlens.session import materialize, release

UNKNOWN = "und"
# Occurrences that a task counts at a time, about; a phrase is sent once for so many.
AT_ONCE = 1 << 21
# The first rows of a language are found in so many parts before they meet.
TOP_PARTS = 8

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09]] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IN_WORD = ~(_BLANK | _BREAK)
# Any other order of the byte values gives words a second hash.
_OTHER_BYTES = np.random.default_rng(11).permutation(256).astype(np.uint8)
# Spreads the bits of one shard's phrases away from another's.
_SHARD_FACTOR = 0x5BD1E995


def _in_shard(keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
    """Keys that differ from shard to shard."""
    return keys ^ (shards.astype(np.uint64) * np.uint64(_SHARD_FACTOR))


def _in_shard_column() -> Column:
    return F.col("key").bitwiseXOR(F.col("part").bitwiseAND(F.lit(0xFFFF)).cast("long") * F.lit(_SHARD_FACTOR))


class _Piece:
    """The words of some rows, and which of them stand next to each other."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lang: np.ndarray, shard: np.ndarray):
        self.data = W.LOWER[data]
        self.starts, self.ends, rows = W.find_words(self.data, bounds, _IN_WORD)
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(rows))
        self.words_of_row = np.diff(rows)
        self.hashes = W.hash_words(self.data, self.starts, self.ends)
        self._lang, self._shard = lang.view(np.uint64), shard
        self._keys: dict[int, np.ndarray] = {}
        self._other: np.ndarray | None = None
        breaks = np.cumsum(_BREAK[self.data], dtype=np.int32)
        self._joined = np.zeros(len(self.starts), dtype=bool)
        if len(self.starts):
            same_row = self.row[1:] == self.row[:-1]
            self._joined[:-1] = same_row & (breaks[self.starts[1:]] == breaks[self.ends[:-1] - 1])

    def phrases(self, length: int) -> np.ndarray:
        """The first word of every phrase of ``length`` words."""
        count = max(0, len(self.starts) - length + 1)
        whole = np.ones(count, dtype=bool)
        for place in range(length - 1):
            whole &= self._joined[place : place + count]
        return np.flatnonzero(whole)

    def keys(self, length: int) -> np.ndarray:
        """A number for the phrase of ``length`` words from each word on, and its language."""
        if length not in self._keys:
            runs = W.hash_runs(self.hashes, length)
            self._keys[length] = W.mixed(runs ^ self._lang[self.row[: len(runs)]])
        return self._keys[length]

    def shards(self, first: np.ndarray) -> np.ndarray:
        return self._shard[self.row[first]]

    def other_keys(self, first: np.ndarray, length: int) -> np.ndarray:
        if self._other is None:
            self._other = W.hash_words(_OTHER_BYTES[self.data], self.starts, self.ends)
        return W.hash_runs(self._other, length)[first]

    def texts(self, first: np.ndarray, length: int) -> pa.Array:
        """The phrases' words with one space between them."""
        begin, end = self.starts[first], self.ends[first + length - 1]
        sizes = end - begin
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = self.data[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], sizes)]
        blank = _BLANK[data]
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        data[blank] = 0x20
        kept = np.concatenate([[0], np.cumsum(keep)])
        return pa.Array.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(kept[offsets].astype(np.int64)), pa.py_buffer(data[keep])]
        ).cast(pa.large_string())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Piece, pa.Array]]:
    for batch in batches:
        lang, shard = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for first, last, data, bounds in W.text_pieces(batch.column(3)):
            yield _Piece(data, bounds, lang[first:last], shard[first:last]), batch.column(0).slice(first, last - first)


def _part(words: int, shard: int) -> int:
    """One number for a length and a shard."""
    return (words << 16) + shard


def _local_counts(lengths: list[int], frequent: Broadcast | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, key, n) of the phrases of these lengths whose shorter phrases are frequent in the shard; see `_part`."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for length, parts in held.items():
            shards, keys = (np.concatenate(column) for column in zip(*parts))
            for shard in np.unique(shards):
                key, n = np.unique(keys[shards == shard], return_counts=True)
                part = pa.array(np.full(len(key), _part(length, int(shard)), dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part, pa.array(W.as_longs(key)), pa.array(n)], names=["part", "key", "n"])
        held.clear()

    waiting = 0
    for piece, _ in _pieces(batches):
        for length in lengths:
            first = piece.phrases(length)
            shards = piece.shards(first)
            if frequent is not None:
                known, shorter = frequent.value.has, piece.keys(length - 1)
                good = known(_in_shard(shorter[first], shards))
                good[good] = known(_in_shard(shorter[first[good] + 1], shards[good]))
                first, shards = first[good], shards[good]
            held.setdefault(length, []).append((shards, piece.keys(length)[first]))
            waiting += len(first)
        if waiting >= AT_ONCE:
            yield from counted()
            waiting = 0
    yield from counted()


def _distinct(keys: np.ndarray, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the first, number) of equal phrases: those that agree in both hashes."""
    places = np.arange(len(keys))
    while len(places):
        _, first, of, n = np.unique(keys[places], return_index=True, return_inverse=True, return_counts=True)
        strange = others[places] != others[places[first]][of]
        yield places[first], n - np.bincount(of[strange], minlength=len(n))
        places = places[strange]


def _exact_counts(longest: int, candidates: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, words, phrase, n) of all candidates, and of all words under 0 words and no phrase."""

    def rows(langs: pa.Array, words: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [langs.cast(pa.string()), pa.array(np.full(len(n), words, dtype=np.int32)), phrases.cast(pa.string()), pa.array(n.astype(np.int64))],
            names=["lang", "words", "phrase", "n"],
        )

    for piece, langs in _pieces(batches):
        yield rows(langs, 0, pa.nulls(len(langs), pa.string()), piece.words_of_row)
        for length in range(1, longest + 1):
            first = piece.phrases(length)
            keys = piece.keys(length)[first]
            good = candidates.value.has(keys)
            first, keys = first[good], keys[good]
            for at, n in _distinct(keys, piece.other_keys(first, length)):
                yield rows(langs.take(pa.array(piece.row[first[at]])), length, piece.texts(first[at], length), n)


def phrase_counts(documents: DataFrame, support: int = 10, longest: int = 3, shards: int = 4) -> DataFrame:
    """lang, words, phrase and n of all phrases of up to ``longest`` words that occur ``support`` times in a language.

    A row without phrase, of 0 words, holds the number of all words of the language. The rows are stored.
    """
    spark = documents.sparkSession
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards))
    source = documents.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), shard.alias("shard"), text.alias("text"))

    # Words and pairs of them are counted in one pass: few pairs hold a rare word.
    levels: list[DataFrame] = []
    bits: Broadcast | None = None
    for lengths in [list(range(1, min(longest, 2) + 1)), *([length] for length in range(3, longest + 1))]:
        found = source.mapInArrow(partial(_local_counts, lengths, bits), "part int, key long, n long")
        counted = found.groupBy("part", "key").agg(F.sum("n").alias("n"))
        levels.append(materialize(counted.where(F.col("n") * shards >= support)))
        if bits is not None:
            bits.destroy()
        last = materialize(levels[-1].where(F.col("part") >= _part(lengths[-1], 0)).select(_in_shard_column().alias("key")))
        bits = bit_table(last) if lengths[-1] < longest else None
        release(last)

    # In a shard where it is not frequent, a phrase has fewer than support / shards.
    most_elsewhere = (F.lit(shards) - F.count(F.lit(1))) * ((support - 1) // shards)
    known = reduce(DataFrame.unionByName, levels).groupBy("key").agg((F.sum("n") + most_elsewhere).alias("most"))
    union = materialize(known.where(F.col("most") >= support).select("key"))
    bits = bit_table(union)
    found = source.mapInArrow(partial(_exact_counts, longest, bits), "lang string, words int, phrase string, n long")
    exact = found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    stored = materialize(exact.where((F.col("words") == 0) | (F.col("n") >= support)))
    bits.destroy()
    release(union, *levels)
    return stored


def _first_words(phrase: str, count: str):
    return F.expr(f"substring_index({phrase}, ' ', {count})")


def scored_phrases(counts: DataFrame) -> DataFrame:
    """lang, words, phrase, a, l, r and score of every phrase of two words and more among ``counts``.

    The score is that of the phrase's weakest cut into a first part, occurring l times, and a rest, r
    times: floor(10^6 a a / (l r)); of equal ones the earliest. Products are decimals of 38 digits, so they
    are exact up to a = 10^16; beyond that the job fails.
    """
    frequent = counts.where("words > 0")
    parts = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n"))
    cuts = (
        frequent.where("words > 1")
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .withColumn("first", _first_words("phrase", "cut"))
        .withColumn("rest", _first_words("phrase", "cut - words"))
    )
    for side, n in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.select("lang", F.col("part").alias(side), F.col("part_n").alias(n)), ["lang", side])
    score = F.expr("(1000000BD * cast(n as decimal(16, 0)) * n) div (cast(l as decimal(19, 0)) * r)")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("weakest")
    return (
        cuts.groupBy("lang", "words", "phrase", F.col("n").alias("a"))
        .agg(weakest)
        .select("lang", "words", "phrase", "a", "weakest.l", "weakest.r", "weakest.score")
    )


def _explained(counts: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of the phrases that stand inside a longer one at least ``percent`` of the time."""
    frequent = counts.where("words > 1").select("lang", "words", "phrase", "n")
    inside = frequent.select(
        "lang",
        F.col("n").alias("longer_n"),
        F.col("phrase").alias("longer"),
        "words",
        F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.col("words") - 1))).alias("part_words"),
    ).where("part_words < words")
    inside = inside.withColumn("from", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("part_words"))))
    part = F.array_join(F.slice(F.split("longer", " "), F.col("from") + 1, F.col("part_words")), " ")
    most = inside.groupBy("lang", part.alias("phrase")).agg(F.max("longer_n").alias("longer_n"))
    return frequent.join(most, ["lang", "phrase"]).where(F.col("longer_n") * 100 >= F.col("n") * percent).select("lang", "phrase")


def collocations(
    documents: DataFrame, support: int = 10, longest: int = 3, top: int = 2000, explained_percent: int = 50, shards: int = 4
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n and score.

    ``documents`` needs doc_id, lang and text; further columns are ignored, whatever their names. Texts
    are lower-cased (A-Z) and split into pieces at . , ; : ! ? and line breaks, and those into words at spaces
    and tabs; a phrase lies within a piece. A phrase that a longer one explains, since that is at least
    ``explained_percent`` of its occurrences, is left out. Ties of the score go to the larger a, then by
    the phrase's bytes. n is the number of all words of the language.

    A null lang is ``und``, a null text empty. Repeated rows count each time. Very long texts are held whole,
    one at a time. A language without frequent phrases, and an empty table, give no rows.
    """
    counts = phrase_counts(documents, support, longest, shards)
    kept = scored_phrases(counts).join(_explained(counts, explained_percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First in parts, so that the task that ranks a language sees no more rows than TOP_PARTS * top, however many tasks
    # found some.
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    leading = kept.withColumn("part", part).withColumn("place", in_part).where(F.col("place") <= top)
    ranked = leading.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    ranked = ranked.where(F.col("rank") <= top)
    sizes = counts.where("words = 0").select("lang", "n")
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
