"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.session import materialize, release


# So many edges take a task 16 MB; below that, one task is done before two shuffles are planned.
EDGES_OF_A_TASK = 1_000_000


def connected_components(edges: DataFrame, most_rounds: int = 60, edges_of_a_task: int = 0) -> DataFrame:
    """(node, component) of every node of an edge (a, b); the component is its smallest node.

    Large-star and small-star steps in turn until nothing changes: each node hangs its larger
    neighbours, then itself and its smaller ones, below the smallest node it sees. The number of
    rounds grows with the logarithm of a component's diameter, and a round never makes more
    edges than it read. Minima are formed before the shuffle and stored; the join that hands them
    out has one row for a hub on that side, so adaptive splitting spreads the other. Only a count
    and a checksum reach the driver. Nulls and loops are left out; no edges give no rows.

    With ``edges_of_a_task``, a graph counted to have no more edges (a, b of type long) is left to a
    single task, which gives the same.
    """
    edges = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high")
    edges = materialize(edges)
    if edges_of_a_task and edges.count() <= edges_of_a_task:
        return materialize(edges.coalesce(1).mapInArrow(_in_one_task, "node long, component long"))
    raw, edges = edges, materialize(edges.distinct())
    release(raw)
    mark = _mark(edges)
    for _ in range(most_rounds):
        if mark["n"] == 0:
            break
        before = mark
        done = [edges]
        stars = materialize(_large_star(edges, done))
        done.append(stars)
        edges = materialize(_small_star(stars, done))
        release(*done)
        mark = _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    below = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return below.unionByName(roots)


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    if not pairs:
        return
    nodes, place = np.unique(np.concatenate(pairs, axis=1), return_inverse=True)
    low, high = place.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        # Each label moves to the smaller one across an edge, then to the label of its label.
        least = np.minimum(label[low], label[high])
        moved = label.copy()
        for end in (low, high):
            np.minimum.at(moved, label[end], least)
            np.minimum.at(moved, end, least)
        while not np.array_equal(moved, moved[moved]):
            moved = moved[moved]
        if np.array_equal(moved, label):
            break
        label = moved
    yield pa.RecordBatch.from_pydict({"node": nodes, "component": nodes[label]})


def _mark(edges: DataFrame) -> dict:
    return edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("low", "high")).alias("sum")).first().asDict()


def _large_star(edges: DataFrame, stored: list[DataFrame]) -> DataFrame:
    both = edges.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
        edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    )
    least = materialize(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least")))
    stored.append(least)
    larger = edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    return larger.join(least, "node").select(F.col("least").alias("low"), F.col("other").alias("high")).distinct()


def _small_star(edges: DataFrame, stored: list[DataFrame]) -> DataFrame:
    least = materialize(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least")))
    stored.append(least)
    hung = edges.withColumnRenamed("high", "node").join(least, "node")
    below = hung.where("low > least").select(F.col("least").alias("low"), F.col("low").alias("high"))
    own = least.select(F.col("least").alias("low"), F.col("node").alias("high"))
    return below.unionByName(own).distinct()
