"""Language identification by spans: script ranges, word scores and a Viterbi path.

A word's script (by its first character) leaves the languages that were seen in it; each of those
scores the word by the logarithms of its byte trigrams. The best path through a text's words, with
a penalty for every switch of language, labels spans; the text's language is the one with the
most letters in its spans.

The model holds one number per trigram bucket and language, whatever the corpus: tasks count trigrams
into arrays of that size, and only sums leave them.
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

from bazaarlens.llm import words as W

UNKNOWN = "und"
BUCKETS = 1 << 16
# A language is a candidate for a script if at least this share of its words is in it.
LEAST_SHARE = 0.01
_OUT = -1e4

# Scripts by the first byte of a character in UTF-8 (blocks of Unicode).
_SCRIPTS = {
    "latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCB)],
    "greek": [0xCD, 0xCE, 0xCF],
    "cyrillic": [0xD0, 0xD1, 0xD2, 0xD3],
    "armenian_hebrew": [0xD4, 0xD5, 0xD6, 0xD7],
    "arabic": [0xD8, 0xD9, 0xDA, 0xDB],
    "south_asian": [0xE0],
    "south_east_asian": [0xE1],
    "kana_han": [0xE3, 0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9],
    "hangul": [0xEA, 0xEB, 0xEC, 0xED],
}
_SCRIPT_NAMES = [*_SCRIPTS, "other"]
_SCRIPT_OF = np.full(256, len(_SCRIPTS), dtype=np.int64)
for _place, _bytes in enumerate(_SCRIPTS.values()):
    _SCRIPT_OF[_bytes] = _place

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class LanguageModel:
    languages: list[str]
    trigrams: np.ndarray  # BUCKETS x languages: logarithms of shares
    scripts: np.ndarray  # scripts x languages: 0, or _OUT for no candidate


def _prepared(data: np.ndarray, bounds: np.ndarray):
    """Lower-cased bytes with a blank before each row and at the end, and the words in them."""
    rows = len(bounds) - 1
    sizes = np.diff(bounds)
    text = np.full(len(data) + rows + 2, 0x20, dtype=np.uint8)
    lowered = W.LOWER[data]
    # Capital letters of Latin-1, the second byte of two.
    after = np.zeros(len(lowered), dtype=bool)
    after[1:] = (lowered[:-1] == 0xC3) & (lowered[1:] >= 0x80) & (lowered[1:] <= 0x9E) & (lowered[1:] != 0x97)
    lowered[after] += 0x20
    text[np.arange(len(data)) + np.repeat(np.arange(rows), sizes) + 1] = lowered
    text[~_LETTER[text]] = 0x20
    starts, ends, first = W.find_words(text, np.append(bounds[:-1] + np.arange(rows), len(text)), _LETTER)
    wide = text.astype(np.uint32)
    keys = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    keys = ((keys * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    return text, starts, ends, first, keys


def _in_words(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all trigrams of the words (from the blank before on), and whose they are."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    at = np.repeat(starts - 1 - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return at, owner


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trigrams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        names = batch.column(1).to_pylist()
        for first, last, data, bounds in W.text_pieces(batch.column(0), 1 << 19):
            text, starts, ends, word_bounds, keys = _prepared(data, bounds)
            if len(starts) == 0:
                continue
            at, owner = _in_words(starts, ends)
            present = {name: i for i, name in enumerate(dict.fromkeys(names[first:last]))}
            language = np.repeat([present[name] for name in names[first:last]], np.diff(word_bounds))
            found = np.bincount(language[owner] * BUCKETS + keys[at], minlength=len(present) * BUCKETS).reshape(-1, BUCKETS)
            kinds = np.bincount(
                language * len(_SCRIPT_NAMES) + _SCRIPT_OF[text[starts]], minlength=len(present) * len(_SCRIPT_NAMES)
            ).reshape(len(present), -1)
            for name, i in present.items():
                trigrams[name] = trigrams.get(name, 0) + found[i]
                scripts[name] = scripts.get(name, 0) + kinds[i]
    for name in trigrams:
        used = np.flatnonzero(trigrams[name])
        seen = np.flatnonzero(scripts[name])
        yield pa.RecordBatch.from_pydict({
            "lang": [name] * (len(used) + len(seen)),
            "feature": np.concatenate([used, -1 - seen]),
            "n": np.concatenate([trigrams[name][used], scripts[name][seen]]),
        })


def train(documents: DataFrame) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of all given rows; nulls in either teach nothing.

    What reaches the driver is one number per language and bucket. Without rows there are no languages.
    """
    rows = documents.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counted = (
        rows.where("text is not null and lang is not null")
        .mapInArrow(_counts, "lang string, feature long, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(counted["lang"].unique())
    trigrams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((len(_SCRIPT_NAMES), len(languages)))
    place = counted["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(dtype=np.int64)
    feature, n = counted["feature"].to_numpy(), counted["n"].to_numpy(dtype=np.float64)
    is_script = feature < 0
    trigrams[feature[~is_script], place[~is_script]] = n[~is_script]
    scripts[-1 - feature[is_script], place[is_script]] = n[is_script]
    shares = np.log((trigrams + 0.5) / (trigrams.sum(axis=0) + 0.5 * BUCKETS))
    seen = scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=0), 1)
    # A script in which no language was seen leaves all of them.
    allowed = np.where(seen | ~seen.any(axis=1, keepdims=True), 0.0, _OUT)
    return LanguageModel(languages, shares.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """The path of states with the largest sum of scores, less ``switch`` for each change; ties to the smaller state."""
    states = scores.shape[1]
    rows = scores.tolist()
    best = rows[0]
    come: list[list[int]] = []
    for row in rows[1:]:
        top = max(best)
        leader = best.index(top)
        jump = top - switch
        came = [s if best[s] >= jump else leader for s in range(states)]
        best = [(best[s] if came[s] == s else jump) + row[s] for s in range(states)]
        come.append(came)
    state = best.index(max(best))
    path = [state]
    for came in reversed(come):
        state = came[state]
        path.append(state)
    return np.array(path[::-1])


def best_path(scores: np.ndarray, switch: float) -> np.ndarray:
    """What `viterbi` gives, found at once where one language is best throughout.

    Leaving it for a while costs two switches, at an end one; if nowhere the words in between
    win as much, the best path never leaves.
    """
    total = scores.sum(axis=0)
    state = int(np.argmax(total))
    if scores.shape[1] > 1:
        others = np.delete(scores, state, axis=1).max(axis=1) - scores[:, state]
        sums = np.concatenate([[0.0], np.cumsum(others)])
        low = np.minimum.accumulate(sums)
        if sums.max() >= switch or sums[-1] - low[-1] >= switch or (sums - low).max() >= 2 * switch:
            return viterbi(scores, switch)
    return np.full(len(scores), state)


def _labelled(model: Broadcast, switch: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = model.value
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32()), ("lang", pa.string())]))
    for batch in batches:
        names, scores, spans = [], [], []
        has_letter = batch.column(2).to_pylist()
        for first, last, data, bounds in W.text_pieces(batch.column(1), 1 << 19):
            text, starts, ends, word_bounds, keys = _prepared(data, bounds)
            letters = (ends - starts).astype(np.float64)
            if len(starts) and model.languages:
                at, _ = _in_words(starts, ends)
                begins = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
                table = np.add.reduceat(model.trigrams[keys[at]], begins, axis=0, dtype=np.float64)
                table += model.scripts[_SCRIPT_OF[text[starts]]]
            for row in range(last - first):
                a, b = word_bounds[row], word_bounds[row + 1]
                if a == b or not has_letter[first + row] or not model.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    spans.append([])
                    continue
                path = best_path(table[a:b], switch)
                weight = np.bincount(path, letters[a:b], len(model.languages))
                winner = int(np.argmax(weight))
                names.append(model.languages[winner])
                scores.append(float(weight[winner] / weight.sum()))
                cuts = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), b - a]
                spans.append([
                    {"first": s, "after": e, "lang": model.languages[path[s]]} for s, e in zip(cuts[:-1], cuts[1:])
                ])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span_type)],
            names=["doc_id", "lang_pred", "score", "spans"],
        )


def identified(documents: DataFrame, model: LanguageModel, switch: float = 12.0) -> DataFrame:
    """doc_id, lang_pred, score and spans (words first to after, and their lang) of every row.

    A word is a run of letters a-z (A-Z lower-cased) and characters beyond ASCII. The score is the
    share of the text's letters, in bytes, in spans of the predicted language. A text that is null
    or has no letter is ``und`` with score 0 and no spans, as all are without learned languages.
    Equal weights go to the language that sorts first. Very long texts are read whole. Repeated rows give repeated results, other
    columns are ignored, and an empty table gives no rows.
    """
    rows = documents.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )
    kind = dict(rows.dtypes)["doc_id"]
    broadcast = documents.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(
        partial(_labelled, broadcast, switch),
        f"doc_id {kind}, lang_pred string, score double, spans array<struct<first:int,after:int,lang:string>>",
    )
