"""Substring de-duplication by runs of consecutive sentences.

Sentences end behind a word that ends in . ! or ?, at a line break, and, where ``cut_every`` words in
a row have no such end, behind the one of least hash among them (winnowing; of equal words the last). So no
sentence is longer than ``cut_every`` words, and a passage that was put into the middle of a sentence
has the same ends inside as everywhere else, from within its first ``cut_every`` words to within its
last: with sentences of at most 8 words and runs of 28 to 35, any passage of over 50 words holds an equal run. From every
sentence on, the shortest run of at least ``sentences`` sentences and ``run_words`` words is hashed, and the
shortest that ends with the text. Of equal runs in the whole corpus, the first by (doc_id, text hash,
place) stays; the words of all others go.

Most runs occur once. So a first pass counts them by 64-bit hashes, eight bytes and a number each, and what occurs more often
reaches the tasks as a bit table of bounded size (see `bits`). A second pass hands on only those runs, with their
places and 128 bits of hash. Runs that repeat within some megabytes of text are found there, so at most one row for
these and a run is shuffled, however frequent a passage is; the first of the others is a minimum, joined back
from a stored table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bazaarlens.llm import words as W
from bazaarlens.llm.bits import bit_table
from bazaarlens.session import materialize, release

# Bytes of text whose runs a task holds at a time, about.
TEXT_AT_ONCE = 8 << 20

# Any other order of the byte values gives words a second hash.
_OTHER_BYTES = np.random.default_rng(4).permutation(256).astype(np.uint8)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True


def sentence_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, hashes: np.ndarray, cut_every: int) -> np.ndarray:
    """Which words end a sentence; a row's last word always does."""
    if len(starts) == 0:
        return np.zeros(0, dtype=bool)
    last = _ENDS[data[ends - 1]]
    breaks = np.cumsum(data == 10)
    last[:-1] |= breaks[starts[1:]] > breaks[ends[:-1] - 1]
    filled = rows[1:][np.diff(rows) > 0] - 1
    last[filled] = True
    # A window that reaches into the next row holds a row's last word, an end already.
    key = np.where(last, np.uint64(0), hashes)
    windows = len(key) - cut_every + 1
    if windows > 0:
        least, at = key[:windows].copy(), np.arange(windows)
        for place in range(1, cut_every):
            other = key[place : place + windows]
            lower = other <= least
            least[lower] = other[lower]
            at[lower] = np.flatnonzero(lower) + place
        last[at] = True
    return last


class _Runs:
    """Every run of a piece: row, first word and word after the last, as arrays."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, sentences: int, run_words: int, cut_every: int):
        self._data = data = W.LOWER[data]
        self._starts, self._ends, rows = W.find_words(data, bounds, W.NOT_BLANK)
        self._hashes = W.hash_words(data, self._starts, self._ends)
        after = np.flatnonzero(sentence_ends(data, self._starts, self._ends, rows, self._hashes, cut_every)) + 1
        begin = np.concatenate([[0], after[:-1]]) if len(after) else after
        count = len(after)
        at = np.arange(count)
        # The run that begins with sentence i ends with the first sentence that makes it long enough.
        final = np.maximum(np.searchsorted(after, begin + run_words), at + sentences - 1)
        row = np.searchsorted(rows, begin, side="right") - 1
        good = final < count
        good[good] = after[final[good]] <= rows[row[good] + 1]
        a, b, of_row = begin[good], after[final[good]], row[good]
        # And the shortest run that ends with a row's last sentence, so that no rest of a copy stays.
        if count:
            filled = np.flatnonzero(np.diff(rows))
            ending = np.searchsorted(after, rows[filled + 1])
            opening = np.minimum(np.searchsorted(begin, after[ending] - run_words, side="right") - 1, ending - sentences + 1)
            fits = (opening >= 0) & (begin[opening] >= rows[filled])
            fits &= ~(good[opening] & (final[opening] == ending))  # there already
            a = np.concatenate([a, begin[opening[fits]]])
            b = np.concatenate([b, after[ending[fits]]])
            of_row = np.concatenate([of_row, filled[fits]])
        self.row, self._a, self._b, self._rows = of_row, a, b, rows

    def hashed(self) -> np.ndarray:
        return self._sums(self._hashes)

    def hashed_again(self) -> np.ndarray:
        """A second hash that owes nothing to the first."""
        return self._sums(W.hash_words(_OTHER_BYTES[self._data], self._starts, self._ends))

    def _sums(self, hashes: np.ndarray) -> np.ndarray:
        a, b = self._a, self._b
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * W._power_table(len(hashes) + 1, False)[: len(hashes)], out=sums[1:])
        return W.mixed((sums[b] - sums[a]) * W._power_table(len(hashes) + 1, True)[a] + (b - a).astype(np.uint64))

    def words(self) -> np.ndarray:
        """First word in the upper four bytes, the one after the last in the lower, counted in the row."""
        return ((self._a - self._rows[self.row]) << 32) + self._b - self._rows[self.row]


def _counted(sentences: int, run_words: int, cut_every: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, n) of the runs of some megabytes of text."""
    for batch in batches:
        held, size = [], 0
        for _, last, data, bounds in W.text_pieces(batch.column(0)):
            held.append(_Runs(data, bounds, sentences, run_words, cut_every).hashed())
            size += len(data)
            if size >= TEXT_AT_ONCE or last == batch.num_rows:
                run, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(W.as_longs(run)), pa.array(n)], names=["run", "n"])
                held, size = [], 0


def _placed(
    repeated: Broadcast, sentences: int, run_words: int, cut_every: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """The places of the runs that the table holds."""
    for batch in batches:
        found, size = [], 0
        for first, last, data, bounds in W.text_pieces(batch.column(2)):
            runs = _Runs(data, bounds, sentences, run_words, cut_every)
            run = runs.hashed()
            known = repeated.value.has(run)
            if known.any():
                found.append((runs.row[known] + first, runs.words()[known], run[known], runs.hashed_again()[known]))
            size += len(data)
            if found and (size >= TEXT_AT_ONCE or last == batch.num_rows):
                yield _marked(batch, *(np.concatenate(parts) for parts in zip(*found)))
                found, size = [], 0


def _marked(batch: pa.RecordBatch, row: np.ndarray, words: np.ndarray, run: np.ndarray, again: np.ndarray) -> pa.RecordBatch:
    """The first row of each run, and all that repeat one, marked so; equal places are one."""
    ids = batch.column(0)
    order_of_id = ids.fill_null(2**63 - 1).to_numpy(zero_copy_only=False)[row]
    text_hash = batch.column(1).to_numpy()[row]
    order = np.lexsort((words, text_hash, order_of_id, again, run))
    row, words, run, again, order_of_id, text_hash = (x[order] for x in (row, words, run, again, order_of_id, text_hash))
    new = np.ones(len(run), dtype=bool)
    new[1:] = (run[1:] != run[:-1]) | (again[1:] != again[:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(run)), 0))
    repeated = (order_of_id != order_of_id[lead]) | (text_hash != text_hash[lead]) | (words != words[lead])
    keep = repeated | new
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(row[keep])), pa.array(text_hash[keep]), pa.array(W.as_longs(run[keep])),
            pa.array(W.as_longs(again[keep])), pa.array(words[keep]), pa.array(repeated[keep]),
        ],
        names=["doc_id", "text_hash", "run", "again", "words", "repeated"],
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other columns, the text without the words of its spans, how many it had and lost."""
    for batch in batches:
        spans = batch.column(2).to_pylist()
        texts, counts, gone = [], [], []
        for first, last, data, bounds in W.text_pieces(batch.column(1)):
            starts, ends, rows = W.find_words(data, bounds, W.NOT_BLANK)
            counts.extend(np.diff(rows).tolist())
            for row in range(last - first):
                text = data[bounds[row] : bounds[row + 1]].tobytes()
                removed = 0
                if spans[first + row]:
                    kept, at, reach = [], bounds[row], 0
                    for span in sorted(spans[first + row]):
                        a, b = max(span >> 32, reach), span & 0xFFFFFFFF
                        if b <= a:
                            continue
                        kept.append(data[at : max(at, starts[rows[row] + a])].tobytes())
                        word = rows[row] + b
                        at = starts[word] if word < rows[row + 1] else bounds[row + 1]
                        removed += b - a
                        reach = b
                    kept.append(data[at : bounds[row + 1]].tobytes())
                    text = b"".join(kept).strip(b" \t\n\r\x0b\x0c")
                texts.append(text.decode())
                gone.append(removed)
        texts = [text if valid else None for text, valid in zip(texts, batch.column(1).is_valid().to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
            names=["others", "text", "n_words", "n_removed"],
        )


def without_repeated_spans(
    documents: DataFrame, sentences: int = 3, run_words: int = 28, cut_every: int = 8
) -> DataFrame:
    """The documents with all their columns; ``text`` without repeated runs, n_words and n_removed added.

    Words are compared with A-Z lower-cased. Rows that repeat both doc_id and text are one document
    and keep the same words. A document without doc_id comes after all others. Null texts stay
    null, and a text without repeats stays as it is, byte for byte; else white space at its ends
    goes. A text that has fewer words than a run keeps them. Very long texts are held whole, one at a time. An
    empty table gives no rows. Columns named n_words or n_removed are replaced, all others are handed through.
    """
    names = [c for c in documents.columns if c not in ("n_words", "n_removed")]
    keyed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("others"),
        F.col("doc_id").cast("long").alias("_id"),
        # Tells texts under one doc_id, or without any, apart.
        F.xxhash64("text").alias("_hash"),
        F.col("text").cast("string").alias("_text"),
    )
    spans = _spans(keyed.select("_id", "_hash", "_text"), sentences, run_words, cut_every)
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    marked = keyed.join(spans, same, "left").select("others", "_text", "spans")
    result = StructType([
        keyed.schema["others"], StructField("text", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())
    ])
    cleaned = marked.mapInArrow(_without, result)
    return cleaned.select(
        *[F.col("text") if c == "text" else F.col(f"others.`{c}`") for c in names], "n_words", "n_removed"
    )


def _spans(texts: DataFrame, sentences: int, run_words: int, cut_every: int) -> DataFrame:
    """(doc_id, text_hash, spans): the runs of each text (_id, _hash, _text) that are not the first of their kind; stored."""
    how = (sentences, run_words, cut_every)
    counted = texts.select("_text").mapInArrow(partial(_counted, *how), "run long, n long")
    repeated = materialize(counted.groupBy("run").agg(F.sum("n").alias("n")).where("n > 1").select("run"))
    bits = bit_table(repeated)
    found = materialize(
        texts.mapInArrow(
            partial(_placed, bits, *how), "doc_id long, text_hash long, run long, again long, words long, repeated boolean"
        )
    )
    bits.destroy()
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash", "words")
    # One row per run and some megabytes of text. The minimum is formed before the shuffle and stored, so that the join
    # back is split where a run is frequent.
    candidates = found.where("not repeated").select("run", "again", place.alias("place"))
    firsts = candidates.groupBy("run", "again").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = materialize(firsts.drop("n"))
    later = candidates.join(firsts, ["run", "again"]).where(F.col("place") != F.col("first"))
    gone = found.where("repeated").select("doc_id", "text_hash", "words").unionByName(
        later.select("place.doc_id", "place.text_hash", "place.words")
    )
    spans = materialize(gone.groupBy("doc_id", "text_hash").agg(F.collect_set("words").alias("spans")))
    release(repeated, found, firsts)
    return spans
