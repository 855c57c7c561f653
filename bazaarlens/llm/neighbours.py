"""Nearest neighbours: an NN-descent graph of all vectors, searched greedily.

Equal vectors are one point, so a vector that many rows share is one node. Points begin with the
neighbours they have in a few leaves of random hyperplane trees (fitted on a bounded sample), then every
round joins each point's neighbours with each other, in both directions, and keeps the nearest:
neighbours of neighbours are likely neighbours. Only pairs with a neighbour new since the last
round are compared. A point that very many have as neighbour is joined in several groups of bounded size.

A search starts from the query's own neighbours, if it is a point of the graph, and follows the
edges of the nearest points found so far until they are all followed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.llm.groups import grouped, runs
from bazaarlens.session import materialize, release

SAMPLE_ROWS = 20_000  # vectors that the trees are fitted on, at most
LEAF = 192  # points of a leaf that are compared with each other, about
FROM_LEAF = 12  # neighbours that a point takes from each leaf
GROUP = 64  # neighbours joined with each other in one group, at most about
FROM_GROUP = 8  # neighbours that a point takes from a group


def _matrix(column: pa.Array | pa.ChunkedArray, dtype: str = "<f8") -> np.ndarray:
    """Vectors, stored as little-endian numbers, as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors in single precision, enough to choose neighbours by: half the bytes to move."""
    for batch in batches:
        vectors = _matrix(batch.column(1)).astype("<f4") if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["node", "vector"])


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; those that take no part are left out."""
    for batch in batches:
        ids, vectors = [], []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if vec_id is None or not vector or any(x is None for x in vector):
                continue
            vector = np.array(vector, dtype="<f8") + 0.0  # no negative zero
            if np.isfinite(vector).all() and vector.any():
                ids.append(vec_id)
                vectors.append(vector.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.binary())], names=["vec_id", "vector"])


def points(embeddings: DataFrame, keep: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct vectors (node, vector; node is the smallest vec_id), the rows of each (node, vec_id),
    and all rows that take part (vec_id, vector).

    Of equal vectors only the ``keep`` smallest ids can be among the nearest of any query; all
    others are left out of the second table. Vectors of another than the most frequent dimension
    take no part. A vec_id counts once, with the vector whose bytes come first.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    valid = rows.mapInArrow(_encoded, "vec_id long, vector binary").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    valid = materialize(valid)
    usual = valid.groupBy(F.length("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1)
    valid = valid.join(F.broadcast(usual.select("size")), F.length("vector") == F.col("size"), "left_semi")
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    first = valid.withColumn("place", place).where(F.col("place") <= keep)
    node = F.min("vec_id").over(Window.partitionBy("vector"))
    members = materialize(first.withColumn("node", node).select("node", "vec_id", "place"))
    nodes = members.where("place = 1").select("node").join(valid.withColumnRenamed("vec_id", "node"), "node")
    return nodes, members.select("node", "vec_id"), valid


def _trees(sample: np.ndarray, count: int, depth: int, seed: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """Per tree and level: a direction for each node of the level and the median there."""
    random = np.random.default_rng(seed)
    trees = []
    for _ in range(count):
        leaf = np.zeros(len(sample), dtype=np.int64)
        levels = []
        for level in range(depth):
            directions, cuts = np.zeros((1 << level, sample.shape[1])), np.zeros(1 << level)
            for node in range(1 << level):
                here = np.flatnonzero(leaf == node)
                if len(here) < 2:
                    directions[node] = random.normal(size=sample.shape[1])
                    continue
                a, b = sample[random.choice(here, 2, replace=False)]
                directions[node] = a - b
                cuts[node] = np.median(sample[here] @ directions[node])
            side = (sample * directions[leaf]).sum(axis=1) > cuts[leaf]
            leaf = 2 * leaf + side
            levels.append((directions, cuts))
        trees.append(levels)
    return trees


def _leaves(trees: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        vectors = _matrix(batch.column(1), "<f4")
        for number, levels in enumerate(trees.value):
            leaf = np.zeros(len(vectors), dtype=np.int64)
            for directions, cuts in levels:
                leaf = 2 * leaf + ((vectors * directions[leaf]).sum(axis=1) > cuts[leaf])
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf * len(trees.value) + number), batch.column(0), batch.column(1)], names=["leaf", "node", "vector"]
            )


def _squared(vectors: np.ndarray) -> np.ndarray:
    """Squared distances in double precision, also between near copies, where norms would cancel out."""
    vectors = vectors.astype(np.float64)
    vectors -= vectors.mean(axis=0)
    norms = (vectors**2).sum(axis=1)
    both = norms[:, None] + norms[None, :]
    apart = both - 2 * vectors @ vectors.T
    close = apart < 1e-9 * both
    np.fill_diagonal(close, False)
    for i in np.flatnonzero(close.any(axis=1)):
        others = np.flatnonzero(close[i])
        apart[i, others] = ((vectors[others] - vectors[i]) ** 2).sum(axis=1)
    np.fill_diagonal(apart, 0)
    return np.maximum(apart, 0)


def _nearest_in_leaf(keep: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in runs(batches, 2):
        nodes, vectors = group.column("node").to_numpy(), _matrix(group.column("vector"), "<f4")
        if len(nodes) < 2:
            continue
        apart = _squared(vectors)
        np.fill_diagonal(apart, np.inf)
        k = min(keep, len(nodes) - 1)
        nearest = np.argpartition(apart, k - 1, axis=1)[:, :k]
        yield pa.RecordBatch.from_pydict({
            "node": np.repeat(nodes, k), "other": nodes[nearest].ravel(), "d": np.take_along_axis(apart, nearest, axis=1).ravel().astype(np.float64)
        })


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a group, at least one of them new to it, that are nearer than what either has."""
    for group in runs(batches, 2):
        nodes, order = np.unique(group.column("member").to_numpy(), return_index=True)
        if len(nodes) < 2:
            continue
        vectors = _matrix(group.column("vector"), "<f4")[order]
        worst = group.column("worst").to_numpy()[order]
        is_new = np.zeros(len(nodes), dtype=bool)
        np.logical_or.at(is_new, np.searchsorted(nodes, group.column("member").to_numpy()), group.column("is_new").to_numpy(zero_copy_only=False))
        apart = _squared(vectors)
        better = (apart < worst[:, None]) & (is_new[:, None] | is_new[None, :])
        np.fill_diagonal(better, False)
        if len(nodes) > FROM_GROUP + 1:
            apart = np.where(better, apart, np.inf)
            better &= apart <= np.partition(apart, FROM_GROUP - 1, axis=1)[:, FROM_GROUP - 1 : FROM_GROUP]
        a, b = np.nonzero(better)
        yield pa.RecordBatch.from_pydict({"node": nodes[a], "other": nodes[b], "d": apart[a, b].astype(np.float64)})


_EDGES = "node long, other long, d double"


def _kept(edges: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest others of each node, new where they were not there before."""
    best = edges.groupBy("node", "other").agg(F.min("d").alias("d"), F.min("is_new").alias("is_new"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("d", "other"))
    return best.withColumn("place", place).where(F.col("place") <= keep).drop("place")


def neighbour_graph(nodes: DataFrame, keep: int = 32, trees: int = 16, most_rounds: int = 6, settled: float = 0.05, seed: int = 5) -> DataFrame:
    """(node, vector, others): in single precision, and about the ``keep`` nearest others of each node.

    Rounds end when under ``settled`` of all neighbours change.
    """
    spark = nodes.sparkSession
    count = nodes.count()
    sample = nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(SAMPLE_ROWS).select("vector").toArrow()
    depth = max(0, int(np.ceil(np.log2(max(1, min(count, 64 * SAMPLE_ROWS) / LEAF)))))
    fitted = _trees(_matrix(sample.column("vector")) if sample.num_rows else np.zeros((0, 1)), trees, depth, seed)
    short = materialize(nodes.select("node", "vector").mapInArrow(_shortened, "node long, vector binary"))
    leaves = short.mapInArrow(partial(_leaves, spark.sparkContext.broadcast(fitted)), "leaf long, node long, vector binary")
    # A leaf may hold any number of points: it is cut into parts, at random, that a task can compare.
    sizes = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / (4 * LEAF)).alias("parts"))
    # At most 2^14 leaves of each tree, whatever the data.
    parts = leaves.join(F.broadcast(sizes), "leaf").select("leaf", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"), "node", "vector")
    first = grouped(parts, "leaf", "part").mapInArrow(partial(_nearest_in_leaf, min(keep, FROM_LEAF)), _EDGES).withColumn("is_new", F.lit(True))
    edges = materialize(_kept(first, keep))

    for _ in range(most_rounds):
        changed = edges.where("is_new").count()
        if changed <= settled * keep * count:
            break
        worst = edges.groupBy("node").agg(F.max("d").alias("last"), F.count("*").alias("n"))
        # Who joins whom at which centre: a node's neighbours and those that have it as neighbour.
        back = edges.select(F.col("other").alias("centre"), F.col("node").alias("member"), "is_new")
        groups = back.groupBy("centre").agg(F.ceil(F.count("*") / (GROUP - keep)).alias("groups")).where("groups > 1")
        part = F.pmod(F.xxhash64("member"), F.coalesce("groups", F.lit(1)))
        groups = materialize(groups)
        back = back.join(groups, "centre", "left").select("centre", part.alias("part"), "member", "is_new")
        forth = edges.select(F.col("node").alias("centre"), F.lit(0).cast("long").alias("part"), F.col("other").alias("member"), "is_new")
        known = short.join(worst, "node", "left").select(
            F.col("node").alias("member"), "vector", F.when(F.col("n") >= keep, F.col("last")).otherwise(F.lit(float("inf"))).alias("worst")
        )
        members = forth.unionByName(back).join(known, "member").select("centre", "part", "member", "is_new", "vector", "worst")
        found = grouped(members, "centre", "part").mapInArrow(_joined, _EDGES).withColumn("is_new", F.lit(True))
        old, edges = edges, materialize(_kept(edges.withColumn("is_new", F.lit(False)).unionByName(found), keep))
        release(old, groups)

    others = edges.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("d", "other"))).alias("others"))
    graph = short.join(others, "node", "left")
    return materialize(graph.select("node", "vector", F.coalesce(F.col("others.other"), F.array().cast("array<long>")).alias("others")))


def _distances(dtype: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows == 0:
            continue
        apart = _matrix(batch.column(1), dtype).astype(np.float64) - _matrix(batch.column(3), dtype)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(np.sqrt((apart**2).sum(axis=1)))], names=["query", "node", "d"]
        )


def _apart(pairs: DataFrame, queries: DataFrame, vectors: DataFrame, dtype: str) -> DataFrame:
    """(query, node, d) of pairs (query, node)."""
    return (
        pairs.join(vectors.select("node", "vector"), "node")
        .join(queries.select("query", F.col("vector").alias("of_query")), "query")
        .select("query", "of_query", "node", "vector")
        .mapInArrow(partial(_distances, dtype), "query long, node long, d double")
    )


def search(graph: DataFrame, queries: DataFrame, width: int = 160, most_steps: int = 16) -> DataFrame:
    """(query, node, d) of the ``width`` nearest points found for each query (query, vector, start: nodes).

    Each step follows the edges of all points among the nearest that were not followed yet; the search
    ends when there are none.
    """
    place = F.row_number().over(Window.partitionBy("query").orderBy("d", "node"))
    reached = materialize(queries.select("query", F.explode("start").alias("node")).distinct())
    seen, beam = reached, None
    for _ in range(most_steps):
        found = _apart(reached, queries, graph, "<f4").withColumn("is_new", F.lit(True))
        if beam is not None:
            found = found.unionByName(beam.withColumn("is_new", F.lit(False)))
        beam = materialize(found.withColumn("place", place).where(F.col("place") <= width).drop("place"))
        follow = beam.where("is_new").join(graph.select("node", "others"), "node")
        follow = follow.select("query", F.explode("others").alias("node")).distinct()
        beam = beam.drop("is_new")
        reached = materialize(follow.join(seen, ["query", "node"], "left_anti"))
        if reached.isEmpty():
            break
        seen = seen.unionByName(reached)
    return beam


def nearest_neighbours(embeddings: DataFrame, is_query: Column, k: int = 10, keep: int = 32, width: int = 160) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the ``k`` nearest others of each query row.

    ``embeddings`` has vec_id and embedding; ``is_query`` is a condition on vec_id. The graph is built and
    searched in single precision, what is found is ranked in double. Ties go to the
    smaller vec_id. Vectors that are null, empty, all zero or hold null or non-finite components
    take no part, nor do rows without vec_id or of another than the most frequent dimension. Rows that
    repeat a vec_id count once, with the vector whose bytes come first. Further columns are ignored; no
    queries or no vectors give no rows.
    """
    nodes, members, rows = points(embeddings, k + 1)
    nodes = materialize(nodes)
    graph = neighbour_graph(nodes, keep)
    # A query is a point of the graph: it starts there.
    own = materialize(rows.where(is_query).join(nodes, "vector").select(F.col("vec_id").alias("query"), "vector", "node"))
    start = own.select("query", "node").join(graph, "node")
    start = materialize(start.select("query", "vector", F.concat(F.array("node"), "others").alias("start")))
    found = search(graph, start, width).select("query", "node")
    ranked = (
        _apart(found, own, nodes, "<f8")
        .join(members, "node")
        .where("query != vec_id")
        .withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("d", "vec_id")))
        .where(F.col("rank") <= k)
    )
    return ranked.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", F.col("d").alias("score"))
