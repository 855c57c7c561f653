"""Packing of tokenized documents into sequences: best-two-fit over the lengths.

How documents fit together depends on their lengths alone, and there are no more different
lengths than tokens in a sequence. So Spark counts the pieces of each length, the driver packs
that histogram (never larger than ``capacity`` numbers, whatever the data), and the result, runs of
equal bins, goes back as a table to which every piece is joined by its rank among the pieces of
its length. Ranks come from counts per task and length, so that a length that a third of all
pieces have is numbered by as many tasks as hold it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import materialize

END_ID = 1
# Words whose ids a worker process keeps at hand (about 120 MB).
WORDS_KEPT = 600_000
# Ranks that share a row of the slot table at most.
STRETCH = 64


def token_pieces(documents: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece of a document.

    A document's ids are those of its whole text, then ``end_id``. Only longer ones are cut.
    A null text is an empty one: it has the end id alone.
    """
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(texts.dtypes)["doc_id"]
    return texts.mapInArrow(
        partial(_pieces, tokenizer_file, capacity, end_id), f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


class _WordIds(dict):
    """The ids, as bytes, of every word asked for; the first `WORDS_KEPT` of them are kept.

    The tokenizer cuts at white space first, so a text's ids are those of its words in turn. It also
    cuts between letters or digits and punctuation, and lower-cases; so only what is left without
    those is tokenized. Added tokens are found before that, in exact case: words that could hold one are left as
    they are.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self._tokenizer = Tokenizer.from_file(tokenizer_file)

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(b".,;:!?")
        lowered = word.lower()
        if b"<|" in word:
            ids = self._encoded(word)
        elif len(core) < len(word) and core[-1:].isalnum():
            ids = self[core] + self[word[len(core) :]]
        elif lowered != word:
            ids = self[lowered]
        else:
            ids = self._encoded(word)
        if len(self) < WORDS_KEPT:
            self[word] = ids
        return ids

    def _encoded(self, word: bytes) -> bytes:
        if word.isalpha():  # of ASCII letters alone, in lower case: nothing to normalise or to cut
            ids = [token.id for token in self._tokenizer.model.tokenize(word.decode())]
        else:
            ids = self._tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def _word_ids(tokenizer_file: str) -> _WordIds:
    """Kept for all tasks that a worker process runs."""
    return _WordIds(tokenizer_file)


def _pieces(tokenizer_file: str, capacity: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _word_ids(tokenizer_file)
    end = np.array([end_id], dtype="<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            rows, pieces, starts, ids = [], [], [], []
            for row, text in enumerate(part.column(1).to_pylist()):
                whole = b"".join(map(known.__getitem__, (text or "").encode().split())) + end
                for piece, start in enumerate(range(0, len(whole), 4 * capacity)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start // 4)
                    ids.append(whole[start : start + 4 * capacity])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Bins for ``counts[length]`` pieces of each length, as (how many such bins, their lengths).

    A bin is filled greedily, the longest piece that fits first. If a gap is left, its smallest
    piece makes room for the two unpacked pieces that together fit the larger gap most tightly,
    if that fills more than the one did. While the lengths in it last, the same bin comes out
    again, so equal bins are made at once.
    """
    left = counts.astype(np.int64).copy()
    bins: list[tuple[int, list[int]]] = []
    while left.any():
        used: dict[int, int] = {}
        room = capacity
        while True:
            here = np.flatnonzero(left[: room + 1])
            if used and len(here):
                here = here[: np.searchsorted(here, min(used))]
            if len(here) == 0:
                break
            length = int(here[-1])
            used[length] = min(int(left[length]), room // length)
            room -= used[length] * length
        if room > 0:
            smallest = min(used)
            spare = left.copy()
            for length, n in used.items():
                spare[length] -= n
            spare[smallest] += 1
            pair = _tightest_pair(spare, room + smallest)
            if pair and sum(pair) > smallest:
                used[smallest] -= 1
                for length in pair:
                    used[length] = used.get(length, 0) + 1
        used = {length: n for length, n in used.items() if n}
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= times * n
        bins.append((times, [length for length in sorted(used, reverse=True) for _ in range(used[length])]))
    return bins


def _tightest_pair(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two lengths still there whose sum is largest and not above ``room``."""
    here = np.flatnonzero(left[: room + 1] > 0)
    if len(here) == 0:
        return None
    partner = np.searchsorted(here, room - here, side="right") - 1
    # A length is its own partner only if there are two of it; else the next smaller one is.
    alone = (partner >= 0) & (here[partner] == here) & (left[here] < 2)
    partner = partner - alone
    good = partner >= 0
    if not good.any():
        return None
    sums = np.where(good, here + here[partner], -1)
    best = int(np.argmax(sums))
    return int(here[best]), int(here[partner[best]])


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """row, sequence_id and offset for stored pieces: a unique ``row`` (long) and a ``length`` of 1 to ``capacity``.

    The upper bits of ``row`` name the task that wrote the piece, as monotonically_increasing_id
    gives them.
    """
    spark = pieces.sparkSession
    pieces = pieces.select("row", "length", F.shiftright("row", 33).alias("task"))
    per_task = pieces.groupBy("task", "length").count()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("count")).collect():
        counts[length] = n

    slots, taken, first = [], np.zeros(capacity + 1, dtype=np.int64), 0
    for times, lengths in best_two_fit(counts, capacity):
        offset = 0
        for length in lengths:
            # Ranks from taken[length] on go, in turn, to this place of the next `times` bins.
            slots.append((length, int(taken[length]), int(taken[length]) + times, first, offset))
            taken[length] += times
            offset += length
        first += times
    table = spark.createDataFrame(slots, "length long, from_rank long, to_rank long, first_sequence long, offset long")
    # Ranks are matched to slots by equal (length, stretch), then by range within a stretch.
    last = F.floor((F.col("to_rank") - 1) / STRETCH).cast("long")
    table = table.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("from_rank") / STRETCH).cast("long"), last)))

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rank_before"))
    in_task = F.row_number().over(Window.partitionBy("task", "length").orderBy("row"))
    ranked = pieces.withColumn("in_task", in_task).join(starts, ["task", "length"])
    ranked = ranked.withColumn("rank", F.col("rank_before") + F.col("in_task") - 1)
    ranked = ranked.withColumn("stretch", F.floor(F.col("rank") / STRETCH).cast("long"))
    return (
        ranked.join(table, ["length", "stretch"])
        .where("from_rank <= rank and rank < to_rank")
        .select("row", (F.col("first_sequence") + F.col("rank") - F.col("from_rank")).alias("sequence_id"), "offset")
    )


def packed_documents(documents: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = END_ID) -> DataFrame:
    """All pieces of all documents with their ids, a checksum of them, and their place in a sequence.

    Columns: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset. A sequence holds at
    most ``capacity`` ids, without gaps. Null and empty texts are packed with their end id; a null
    doc_id stays null; each row is a document, also a repeated one; further columns are ignored;
    an empty table gives no rows.
    """
    pieces = token_pieces(documents, tokenizer_file, capacity, end_id)
    stored = materialize(
        pieces.withColumn("ids_crc32", F.crc32("ids")).withColumn("row", F.monotonically_increasing_id())
    )
    return stored.join(pack(stored, capacity), "row").drop("row")


def token_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length and the ids of each sequence, its pieces in the order of their offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    ids = F.aggregate("parts", F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(0).cast("long"), lambda n, part: n + part["length"]).alias("length"), ids.alias("ids")
    )
