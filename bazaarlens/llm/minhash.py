"""MinHash near-duplicates by an inverted join of signature coordinates.

1. Every document's set of word shingles gets a digest and a signature of minima. Documents with
   equal sets are one class from here on, however many they are.
2. A class is posted under (coordinate, value) pairs. Of two classes that agree in at least
   ``least`` coordinates, the rarest ``coordinates - least + 1`` pairs of each meet (prefix), so the
   others, the frequent ones among them, are never posted (skip). A class posts nothing at all
   if too few of its pairs occur anywhere else.
3. Within a posting list the whole signatures are compared. Long lists are cut into blocks, and
   every pair of blocks is a task's work of its own. Only a spanning forest of the matches
   leaves a list, never its pairs. The forest's components are families.
4. Within a family, full shingle sets are counted exactly, again block by block, and only a
   spanning forest of confirmed links leaves. Its components are the result.

Pairs below ``least`` matches are not looked at; ``least`` is set so that a pair at the asked
similarity has that few with a chance of one in a million.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm import words as W
from bazaarlens.llm.components import EDGES_OF_A_TASK, connected_components
from bazaarlens.llm.groups import fixed_width, grouped, runs
from bazaarlens.session import materialize

LIST_BLOCK = 512  # classes of a posting list compared at once
SET_BLOCK = 100_000  # shingles of a family compared at once


def least_matches(coordinates: int, percent: int, miss: float = 1e-6) -> int:
    """The most matches that a pair of this similarity fails to have with a chance below ``miss``."""
    p, below, least = percent / 100, 0.0, 0
    while below + comb(coordinates, least) * p**least * (1 - p) ** (coordinates - least) < miss:
        below += comb(coordinates, least) * p**least * (1 - p) ** (coordinates - least)
        least += 1
    return max(least, 1)


def _shingle_sets(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Each row's distinct shingles, sorted: of ``length`` words, or of all its words if it has fewer."""
    data = W.LOWER[data]
    starts, ends, rows = W.find_words(data, bounds, W.NOT_BLANK)
    hashes = W.hash_words(data, starts, ends)
    shingles = W.hash_runs(hashes, length)
    for a, b in zip(rows[:-1], rows[1:]):
        if b - a >= length:
            yield np.unique(shingles[a : b - length + 1])
        else:
            yield W.hash_runs(hashes[a:b], b - a) if b > a else hashes[:0]


def _signatures(length: int, coordinates: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    random = np.random.default_rng(7)
    factors = random.integers(1, 2**31, (coordinates, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = random.integers(0, 2**32, (coordinates, 1), dtype=np.uint32)
    for batch in batches:
        sizes, digests, signatures = [], [], []
        for _, _, data, bounds in W.text_pieces(batch.column(1)):
            for shingles in _shingle_sets(data, bounds, length):
                sizes.append(len(shingles))
                if len(shingles) == 0:
                    digests.append(None)
                    signatures.append(None)
                    continue
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                least = np.full(coordinates, 2**32 - 1, dtype=np.uint32)
                short = (shingles >> np.uint64(32)).astype(np.uint32)
                for at in range(0, len(short), 2048):
                    np.minimum(least, (short[at : at + 2048] * factors + shifts).min(axis=1), out=least)
                signatures.append(least.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            names=["doc_id", "n_shingles", "digest", "signature"],
        )


def _coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, token) rows; a token is a coordinate's number and its value."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            matrix = fixed_width(part.column(1), np.uint32).astype(np.int64)
            tokens = (matrix << 8) + np.arange(matrix.shape[1])
            yield pa.RecordBatch.from_pydict({
                "rep": np.repeat(part.column(0).to_numpy(), matrix.shape[1]), "token": tokens.ravel()
            })


def _block_pairs(block: Column, blocks: Column) -> Column:
    """Every (first, second) pair of blocks that a row of ``block`` belongs to."""
    return F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(F.least(block, other).alias("first"), F.greatest(block, other).alias("second")),
    )


def _forest(size: int, blocks: np.ndarray, linked) -> list[tuple[int, int]]:
    """Edges that join what ``linked(i, others)`` links; pairs already joined are not compared.

    Where the group is of two blocks, only pairs across them are compared: those inside are the
    work of a group of one block.
    """
    label = np.arange(size)
    edges = []
    across = blocks[0] != blocks[-1] if size else False
    for i in range(size - 1):
        others = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if across:
            others = others[blocks[others] != blocks[i]]
        if len(others) == 0:
            continue
        for j in linked(i, others):
            if label[j] != label[i]:
                edges.append((i, j))
                label[label == label[j]] = label[i]
    return edges


def _matches(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out_a, out_b = [], []
    for group in runs(batches, 3):
        if group.num_rows < 2:
            continue
        reps = group.column("rep").to_numpy()
        matrix = fixed_width(group.column("signature"), np.uint32)
        blocks = group.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        reps, matrix, blocks = reps[order], matrix[order], blocks[order]

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            return others[(matrix[others] == matrix[i]).sum(axis=1) >= least]

        for i, j in _forest(len(reps), blocks, linked):
            out_a.append(reps[i])
            out_b.append(reps[j])
        if len(out_a) > 10_000:
            yield pa.RecordBatch.from_pydict({"a": out_a, "b": out_b})
            out_a, out_b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _full_sets(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [
            shingles.tobytes()
            for _, _, data, bounds in W.text_pieces(batch.column(3))
            for shingles in _shingle_sets(data, bounds, length)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(sets, pa.binary())],
            names=["family", "blocks", "rep", "shingles"],
        )


def _confirmed(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of the links between the sets of each group, counted exactly."""
    out_a, out_b = [], []
    for group in runs(batches, 3):
        if group.num_rows < 2:
            continue
        blocks = group.column("block").to_numpy()
        order = np.argsort(blocks, kind="stable")
        reps, blocks = group.column("rep").to_numpy()[order], blocks[order]
        found = group.column("shingles").to_pylist()
        sets = [np.frombuffer(found[i], dtype=np.uint64) for i in order]
        sizes = np.array([len(s) for s in sets])
        values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        # Who has each value, as one array with a start per value.
        holders = owner[np.argsort(place, kind="stable")]
        first = np.concatenate([[0], np.cumsum(count)])

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            mine = place[begin[i] : begin[i + 1]]
            mine = mine[count[mine] > 1]
            if 100 * len(mine) < percent * sizes[i]:
                return others[:0]
            lengths = count[mine]
            at = np.repeat(first[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            shared = np.bincount(holders[at], minlength=len(sets))[others]
            return others[100 * shared >= percent * (sizes[i] + sizes[others] - shared)]

        for i, j in _forest(len(reps), blocks, linked):
            out_a.append(reps[i])
            out_b.append(reps[j])
    yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _families(classes: DataFrame, coordinates: int, least: int) -> DataFrame:
    """(node, component) of the classes that match in enough coordinates, directly or by others."""
    # A document id that comes with several texts has the tokens of all of them, and a longer prefix.
    tokens = classes.select("rep", "signature").mapInArrow(_coordinates, "rep long, token long")
    # Counts are stored, here and below, so that both sides of the joins come straight from a shuffle:
    # only then does adaptive splitting spread a token that very many classes have.
    shared = materialize(tokens.groupBy("token").count().where("count > 1"))
    ranked = (
        tokens.join(shared, "token")
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("count", "token"))).alias("pairs"))
        # Pairs that no other class has are the rarest of all and use up a place in the prefix.
        .withColumn("posted", F.size("pairs") - F.lit(least - 1))
        .where("posted > 0")
        .select("rep", F.explode(F.slice("pairs", F.lit(1), F.col("posted"))["token"]).alias("token"))
    )
    posted = materialize(ranked)
    lists = materialize(posted.groupBy("token").count().where("count > 1"))
    blocks = F.ceil(F.col("count") / LIST_BLOCK).cast("int")
    rows = (
        posted.join(lists, "token")
        .join(classes.select("rep", "signature"), "rep")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .select("token", "rep", "signature", "block", F.explode(_block_pairs(F.col("block"), F.col("blocks"))).alias("pair"))
        .select("token", "pair.first", "pair.second", "block", "rep", "signature")
    )
    matches = grouped(rows, "token", "first", "second").mapInArrow(partial(_matches, least), "a long, b long")
    return connected_components(matches, edges_of_a_task=EDGES_OF_A_TASK)


def near_duplicates(
    documents: DataFrame, shingle_words: int = 5, percent: int = 80, coordinates: int = 48
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable by links) and kept.

    Documents are linked where 100 * shared >= percent * all of their distinct shingles. Words
    are separated by ASCII white space, A-Z lower-cased. A text with fewer words than a shingle is
    one shingle; without words (null, empty, blank) it is linked with nothing. Very long texts are compared whole. Rows without doc_id
    take no part: component_id null, kept. Rows that repeat a doc_id are one node of the graph:
    each row appears in the result, with what any of their texts is linked to. Further columns are
    ignored; an empty table gives no rows. Ids must be integers.
    """
    least = least_matches(coordinates, percent)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(
        texts.mapInArrow(
            partial(_signatures, shingle_words, coordinates), "doc_id long, n_shingles long, digest binary, signature binary"
        )
    )
    classes = materialize(
        signed.where("doc_id is not null and digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"))
    )
    families = _families(classes, coordinates, least)
    members = classes.groupBy(F.col("rep").alias("node")).agg(F.max("n_shingles").alias("n_shingles")).join(families, "node")
    members = materialize(members.withColumnRenamed("component", "family"))
    sizes = materialize(
        members.groupBy("family").agg(
            F.ceil(F.sum("n_shingles") / SET_BLOCK).alias("by_size"), F.ceil(F.count("*") / LIST_BLOCK).alias("by_count")
        )
    )
    to_read = members.join(sizes, "family").select(
        "family", F.greatest("by_size", "by_count").cast("int").alias("blocks"), F.col("node").alias("rep")
    )
    full = (
        # The members grow with the corpus: both sides are shuffled at any size.
        to_read.hint("merge").join(texts, F.col("rep") == F.col("doc_id"))
        .select("family", "blocks", "rep", "text")
        .mapInArrow(partial(_full_sets, shingle_words), "family long, blocks int, rep long, shingles binary")
        .where(F.length("shingles") > 0)
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("pair", F.explode(_block_pairs(F.col("block"), F.col("blocks"))))
        .select("family", "pair.first", "pair.second", "block", "rep", "shingles")
    )
    links = grouped(full, "family", "first", "second").mapInArrow(partial(_confirmed, percent), "a long, b long")
    # Equal sets are links already; a repeated id joins the classes of its texts.
    same_id = (
        signed.where("doc_id is not null and digest is not null")
        .groupBy("doc_id")
        .agg(F.min("digest").alias("one"), F.max("digest").alias("other"))
        .where("one != other")
        .select("doc_id")
    )
    tied = (
        signed.join(same_id, "doc_id", "left_semi")
        .join(classes.select("digest", "rep"), "digest")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    components = connected_components(links.unionByName(tied), edges_of_a_task=EDGES_OF_A_TASK)
    of_class = classes.select("digest", "rep").join(components, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    return (
        signed.drop("signature")
        .join(of_class, "digest", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def deduplicated(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns; rows without id stay."""
    dropped = near_duplicates(documents, shingle_words, percent).where("not kept").select("doc_id").distinct()
    return documents.join(dropped, "doc_id", "left_anti")


def one_row_of_each_group(documents: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicate texts, with all its columns, whatever the ids.

    Every row is judged by its own text, rows without doc_id and rows that repeat one too. Of a group the
    row with the smallest doc_id stays, one without id only where none has any. Texts without words stay.
    """
    rows = materialize(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("others"),
        )
    )
    texts = rows.select(F.col("row").alias("doc_id"), F.col("others.text").alias("text"))
    groups = near_duplicates(texts, shingle_words, percent).select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("row", "doc_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")).alias("first")
    kept = groups.join(ids, "row").groupBy("component_id").agg(first).select(F.col("first.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*[F.col(f"others.`{c}`").alias(c) for c in documents.columns])
