"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairwise part is
half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, so that a document costs time in proportion to its words.
The model is fitted on a bounded sample of labelled rows; its size depends on two parameters only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from bazaarlens.llm import words as W

STRUCTURE = (
    "log_bytes log_words word_bytes upper digits symbols pipes beyond_ascii same_as_before distinct "
    "most_frequent with_symbol log_lines line_bytes repeated_lines unended_lines log_n_chars no_n_chars"
).split()

_CLASSES = {
    "upper": range(0x41, 0x5B),
    "digits": range(0x30, 0x3A),
    "symbols": [b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-|"],
    "pipes": [ord("|")],
    "beyond_ascii": range(0x80, 0x100),
}
_IN_CLASS = {name: np.isin(np.arange(256), list(members)) for name, members in _CLASSES.items()}
_IN_LINE = np.ones(256, dtype=bool)
_IN_LINE[[10, 13]] = False
_ENDED = np.isin(np.arange(256), [ord(c) for c in ".!?:;\"')"])


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray  # a weight per feature: hashed words first, then structure
    factors: np.ndarray  # a short vector per feature
    mean: np.ndarray
    spread: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.linear) - len(STRUCTURE)

    def score(self, words: tuple[np.ndarray, np.ndarray, np.ndarray], structure: np.ndarray) -> np.ndarray:
        """Of (row, bucket, share) of all words and the rows' structure statistics."""
        row, bucket, share = words
        rows = len(structure)
        dense = np.clip((structure - self.mean) / self.spread, -4, 4)
        own = np.arange(self.buckets, len(self.linear))
        total = self.bias + np.bincount(row, self.linear[bucket] * share, rows) + dense @ self.linear[own]
        squares = np.bincount(row, (self.factors[bucket] ** 2).sum(axis=1) * share**2, rows)
        squares += dense**2 @ (self.factors[own] ** 2).sum(axis=1)
        for f in range(self.factors.shape[1]):
            summed = np.bincount(row, self.factors[bucket, f] * share, rows) + dense @ self.factors[own, f]
            total += 0.5 * summed**2
        return 1 / (1 + np.exp(-np.clip(total - 0.5 * squares, -35, 35)))


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds]).astype(np.float64)


def features(data: np.ndarray, bounds: np.ndarray, n_chars: np.ndarray, buckets: int):
    """(row, bucket, share of the row's words) and the structure statistics of a piece's rows."""
    rows = len(bounds) - 1
    size = np.diff(bounds).astype(np.float64)
    lowered = W.LOWER[data]
    starts, ends, first = W.find_words(lowered, bounds, W.NOT_BLANK)
    hashes = W.hash_words(lowered, starts, ends)
    n = np.diff(first).astype(np.float64)
    owner = np.repeat(np.arange(rows), np.diff(first))
    key, count = np.unique(owner * buckets + (hashes % np.uint64(buckets)).astype(np.int64), return_counts=True)
    row, bucket = key // buckets, key % buckets
    share = count / np.sqrt(np.bincount(row, count.astype(np.float64) ** 2, rows))[row] if len(key) else count.astype(float)

    some, one = np.maximum(n, 1), np.maximum(size, 1)
    table = {name: _per_row(flags[data], bounds) / one for name, flags in _IN_CLASS.items()}
    symbol = np.concatenate([[0], np.cumsum(_IN_CLASS["symbols"][data])])
    with_symbol = (symbol[ends] > symbol[starts]).astype(np.float64)
    before = np.zeros(len(hashes))
    before[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    most = np.zeros(rows)
    np.maximum.at(most, row, count)

    line_start, line_end, line_first = W.find_words(lowered, bounds, _IN_LINE)
    lines = np.diff(line_first).astype(np.float64)
    line_owner = np.repeat(np.arange(rows), np.diff(line_first))
    line_hash = W.hash_words(lowered, line_start, line_end)
    order = np.lexsort((line_hash, line_owner))
    again = np.zeros(len(order))
    again[1:] = (line_hash[order][1:] == line_hash[order][:-1]) & (line_owner[order][1:] == line_owner[order][:-1])
    unended = ~_ENDED[lowered[line_end - 1]] if len(line_end) else np.zeros(0, dtype=bool)
    known = ~np.isnan(n_chars)
    table |= {
        "log_bytes": np.log1p(size),
        "log_words": np.log1p(n),
        "word_bytes": np.bincount(owner, ends - starts, rows) / some,
        "same_as_before": np.bincount(owner, before, rows) / some,
        "distinct": np.bincount(row, minlength=rows) / some,
        "most_frequent": most / some,
        "with_symbol": np.bincount(owner, with_symbol, rows) / some,
        "log_lines": np.log1p(lines),
        "line_bytes": size / np.maximum(lines, 1),
        "repeated_lines": np.bincount(line_owner[order], again, rows) / np.maximum(lines, 1),
        "unended_lines": np.bincount(line_owner, unended, rows) / np.maximum(lines, 1),
        "log_n_chars": np.log1p(np.where(known, np.maximum(n_chars, 0), 0)),
        "no_n_chars": (~known).astype(np.float64),
    }
    return (row, bucket, share), np.stack([table[name] for name in STRUCTURE], axis=1)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def _sampled(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buckets_of, shares, stats = [], [], []
        n_chars = _numbers(batch.column(1))
        for first, last, data, bounds in W.text_pieces(batch.column(0)):
            (row, bucket, share), structure = features(data, bounds, n_chars[first:last], buckets)
            at = np.searchsorted(row, np.arange(last - first + 1))
            for i in range(last - first):
                buckets_of.append(bucket[at[i] : at[i + 1]])
                shares.append(share[at[i] : at[i + 1]].astype(np.float32))
                stats.append(structure[i])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(buckets_of, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32())),
                pa.array(stats, pa.list_(pa.float64())), batch.column(2),
            ],
            names=["buckets", "shares", "structure", "label"],
        )


def _scored(model: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine: FactorisationMachine = model.value
    for batch in batches:
        scores = []
        n_chars = _numbers(batch.column(1))
        for first, last, data, bounds in W.text_pieces(batch.column(0).field("text")):
            scores.append(machine.score(*features(data, bounds, n_chars[first:last], machine.buckets)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["others", "score"]
        )


def _with_n_chars(documents: DataFrame):
    if "n_chars" not in documents.columns:
        return F.lit(None).cast("double")
    return F.expr("try_cast(n_chars as double)")


def train(
    documents: DataFrame, labels: DataFrame, sample_rows: int = 6000, buckets: int = 1 << 14, rank: int = 6,
    rounds: int = 12, seed: int = 11,
) -> FactorisationMachine:
    """Fit on at most ``sample_rows`` labelled rows, those with the smallest hashes of their doc_id; of rows that repeat
    one, that with the smallest hash of its text.

    ``labels`` has doc_id and label (0 or 1; other values and nulls are left out). Without rows of
    both labels every document scores alike: the smoothed share of label 1.
    """
    chosen = (
        labels.select("doc_id", F.col("label").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .withColumn("_order", F.xxhash64("doc_id"))
        .orderBy("_order", "doc_id", "label")
        .limit(sample_rows)
        .drop("_order")
    )
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"), _with_n_chars(documents).alias("n_chars"))
    row = F.struct("text", "n_chars")
    sample = (
        # At most sample_rows ids, and one row for each.
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min_by(row, F.xxhash64("text", "n_chars")).alias("row"))
        .select("row.text", "row.n_chars", "label")
        .mapInArrow(partial(_sampled, buckets), "buckets array<int>, shares array<float>, structure array<double>, label int")
        .toArrow()
    )
    y = sample.column("label").to_numpy().astype(np.float64)
    features_count = buckets + len(STRUCTURE)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        zero = np.zeros(features_count)
        nothing, ones = np.zeros(len(STRUCTURE)), np.ones(len(STRUCTURE))
        return FactorisationMachine(float(np.log(share / (1 - share))), zero, np.zeros((features_count, rank)), nothing, ones)
    lists = [c.combine_chunks() for c in (sample.column("buckets"), sample.column("shares"))]
    bounds = lists[0].offsets.to_numpy()
    bucket, share = lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy()
    structure = np.array(sample.column("structure").to_pylist())
    mean, spread = structure.mean(axis=0), structure.std(axis=0) + 1e-6
    dense = np.clip((structure - mean) / spread, -4, 4)

    random = np.random.default_rng(seed)
    linear = np.zeros(features_count)
    factors = random.normal(0, 0.01, (features_count, rank))
    state = [np.full_like(linear, 1e-8), np.full_like(factors, 1e-8)]
    bias, bias_state = float(np.log(y.mean() / (1 - y.mean()))), 1e-8
    own = np.arange(buckets, features_count)
    # Adagrad over small batches, with a little decay of every weight that a batch uses.
    for _ in range(rounds):
        for batch in np.array_split(random.permutation(len(y)), max(1, len(y) // 128)):
            sizes = np.diff(bounds)[batch]
            at = np.repeat(bounds[batch] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            row = np.concatenate([np.repeat(np.arange(len(batch)), sizes), np.repeat(np.arange(len(batch)), len(own))])
            index = np.concatenate([bucket[at], np.tile(own, len(batch))])
            x = np.concatenate([share[at], dense[batch].ravel()]).astype(np.float64)
            vx = factors[index] * x[:, None]
            summed = np.stack([np.bincount(row, vx[:, f], len(batch)) for f in range(rank)], axis=1)
            total = bias + np.bincount(row, linear[index] * x, len(batch))
            total += 0.5 * (summed**2).sum(axis=1) - 0.5 * np.bincount(row, (vx**2).sum(axis=1), len(batch))
            error = (1 / (1 + np.exp(-np.clip(total, -35, 35))) - y[batch]) / len(batch)
            slope = error[row]
            bias_state += error.sum() ** 2
            bias -= 0.1 * error.sum() / np.sqrt(bias_state)
            used, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, slope * x, len(used)) + 1e-5 * linear[used]
            state[0][used] += step**2
            linear[used] -= 0.1 * step / np.sqrt(state[0][used])
            pull = (slope * x)[:, None] * (summed[row] - vx)
            step = np.stack([np.bincount(place, pull[:, f], len(used)) for f in range(rank)], axis=1) + 1e-5 * factors[used]
            state[1][used] += step**2
            factors[used] -= 0.03 * step / np.sqrt(state[1][used])
    return FactorisationMachine(bias, linear, factors, mean, spread)


def scored(documents: DataFrame, model: FactorisationMachine) -> DataFrame:
    """The documents with all their columns and ``score`` (0 to 1; higher: label 1 is likelier).

    Whole texts are scored. A null text is scored as an empty one, by structure and metadata alone; a
    missing or unreadable n_chars is a feature of its own. Repeated rows score alike, an
    empty table gives no rows. A column named score is replaced, all others are handed through.
    """
    names = [c for c in documents.columns if c != "score"]
    packed = documents.select(
        # The text is moved once: in the place that it has among the columns.
        F.struct(*[F.col("text").cast("string").alias("text") if c == "text" else F.col(f"`{c}`") for c in names]).alias("others"),
        _with_n_chars(documents).alias("_n_chars"),
    )
    broadcast = documents.sparkSession.sparkContext.broadcast(model)
    result = packed.mapInArrow(partial(_scored, broadcast), StructType([packed.schema["others"], StructField("score", DoubleType())]))
    return result.select(*[F.col(f"others.`{c}`") for c in names], "score")
