import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm.neighbours import _squared, nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, node long, query long, vector string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 1, 2, "x") for i, v in vectors], SCHEMA).repartition(3)


def exact(vectors, query, k):
    mine = np.array(dict(vectors)[query], dtype=np.float32).astype(float)
    rows = sorted((float(np.sqrt(((np.array(v, dtype=np.float32).astype(float) - mine) ** 2).sum())), i) for i, v in vectors if i != query)
    return [(i, d) for d, i in rows[:k]]


def results(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 24))
    vectors = [(i, (centres[i % 8] + 0.6 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(1500)]
    vectors += [(1500 + i, vectors[7][1]) for i in range(400)]
    got = results(nearest_neighbours(table(spark, vectors), F.col("vec_id") % 50 == 7))
    queries = [i for i, _ in vectors if i % 50 == 7]
    assert sorted(got) == queries
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact(vectors, q, 10)}) for q in queries)
    assert all(len(got[q]) == 10 for q in queries) and hits >= 0.9 * 10 * len(queries)
    assert got[7] == exact(vectors, 7, 10) and [i for i, _ in got[7]] == list(range(1500, 1510))


def test_recall_among_near_copies(spark):
    rng = np.random.default_rng(9)
    spread = rng.normal(size=(1000, 64))
    near = spread[0] / np.linalg.norm(spread[0]) + 3e-5 * rng.normal(size=(500, 64))
    unit = np.concatenate([spread / np.linalg.norm(spread, axis=1, keepdims=True), near])[rng.permutation(1500)]
    vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(unit)]
    got = results(nearest_neighbours(table(spark, vectors), F.col("vec_id") % 20 == 7))
    copies = [q for q in got if exact(vectors, q, 1)[0][1] < 1e-2]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact(vectors, q, 10)}) for q in copies)
    assert len(copies) > 10 and hits >= 0.9 * 10 * len(copies), hits / len(copies)


def test_distances_of_near_copies():
    rng = np.random.default_rng(2)
    vectors = (np.repeat(rng.normal(size=(2, 64)), 20, axis=0) + 1e-4 * rng.normal(size=(40, 64))).astype("<f4")
    apart = ((vectors[:, None].astype(float) - vectors[None]) ** 2).sum(axis=2)
    assert np.allclose(_squared(vectors), apart, rtol=1e-5, atol=0)


def test_few_and_odd_vectors(spark):
    vectors = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, -0.0]), (4, [-1.0, 0.0])]
    odd = [(10, None), (11, []), (12, [0.0, 0.0]), (13, [None, 1.0]), (14, [float("nan"), 1.0]), (15, [float("inf"), 0.0]),
           (None, [1.0, 1.0]), (16, [1.0, 2.0, 3.0]), (2, [0.0, 1.0]), (2, [9.0, 9.0])]
    got = results(nearest_neighbours(table(spark, vectors + odd), F.col("vec_id") >= 0))
    assert sorted(got) == [0, 1, 2, 3, 4]
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in exact(vectors, q, 10)]
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in exact(vectors, q, 10)], abs=1e-15)


def test_nothing_to_search(spark):
    vectors = [(1, [1.0, 0.0]), (2, [0.5, 0.0])]
    assert nearest_neighbours(table(spark, vectors), F.col("vec_id") > 5).count() == 0
    assert nearest_neighbours(table(spark, vectors).limit(0), F.col("vec_id") > 0).count() == 0
    assert nearest_neighbours(table(spark, vectors[:1]), F.col("vec_id") == 1).count() == 0
