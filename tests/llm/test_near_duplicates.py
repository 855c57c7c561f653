import random

import pytest

from bazaarlens.llm import minhash
from bazaarlens.llm.components import connected_components
from bazaarlens.llm.minhash import deduplicated, least_matches, near_duplicates


def shingles(text, k):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute_force(rows, k, percent):
    """component of each doc_id by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (a, s) in enumerate(sets):
        for b, t in sets[x + 1 :]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: find(i) for i in parent}


def edited(words, edits, rng):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    """Chains of near copies on both sides of the threshold, a shared passage, exact copies."""
    rng = random.Random(3)
    rows, passage = [], " ".join(f"shared{i}" for i in range(60))
    for group in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(40, 160))]
        for _ in range(rng.randrange(1, 14)):
            rows.append(edited(base, rng.randrange(0, 9), rng))
        rows.append(passage + " " + " ".join(f"own{group}_{i}" for i in range(rng.randrange(8, 60))))
    rows += [rows[0]] * 20 + [passage] * 3
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("list_block,set_block", [(512, 100_000), (4, 300)])
def test_same_components_as_all_pairs(spark, corpus, monkeypatch, list_block, set_block):
    monkeypatch.setattr(minhash, "LIST_BLOCK", list_block)
    monkeypatch.setattr(minhash, "SET_BLOCK", set_block)
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in near_duplicates(df, 4, 80).collect()}
    assert got == brute_force(corpus, 4, 80)


def test_odd_documents(odd_documents):
    rows = near_duplicates(odd_documents).collect()
    got = {(r.doc_id, r.component_id, r.kept) for r in rows}
    assert len(rows) == odd_documents.count()
    assert {(1, 1, True), (2, 1, False), (11, 1, False), (7, 7, True), (8, 7, False), (9, 9, True)} <= got
    assert {(3, 3, True), (4, 4, True), (5, 5, True), (None, None, True), (6, 6, True), (12, 6, False)} <= got
    sizes = {r.doc_id: r.n_shingles for r in rows}
    assert sizes[3] == sizes[4] == sizes[5] == 0 and sizes[7] == 1


def test_one_document_of_each_group_stays(odd_documents):
    kept = deduplicated(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 9, 9, 10, 13]
    assert kept.where("doc_id is null").count() == 2


def test_texts_of_one_id_are_one_node(spark):
    rows = [(1, "a b c d e f g h"), (5, "a b c d e f g h"), (5, "q r s t u v w x"), (7, "q r s t u v w x")]
    got = {(r.doc_id, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (5, 1), (7, 1)}


def test_no_documents(no_documents):
    assert near_duplicates(no_documents).count() == 0


def test_least_matches_miss_one_in_a_million():
    from math import comb

    for n in (16, 48, 64):
        least = least_matches(n, 80)
        assert sum(comb(n, i) * 0.8**i * 0.2 ** (n - i) for i in range(least)) < 1e-6
        assert sum(comb(n, i) * 0.8**i * 0.2 ** (n - i) for i in range(least + 1)) >= 1e-6


def test_components_in_one_task_and_by_stars_agree(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    pairs += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2060)] + [(7, None), (8, 8)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    stars = sorted(map(tuple, connected_components(edges).collect()))
    assert stars == sorted(map(tuple, connected_components(edges, edges_of_a_task=10**6).collect()))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    assert stars == sorted((x, find(x)) for x in list(parent))
    assert connected_components(edges.limit(0)).count() == 0
