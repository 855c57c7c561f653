"""Phrase collocations: brute force over odd rows, and what the passes hand on."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from bazaarlens.llm import collocations as C
from bazaarlens.llm.collocations import collocations, phrase_counts, scored_phrases

SCHEMA = "doc_id long, lang string, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    sizes, found = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                found.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return sizes, found


def brute_force(rows, support=10, top=2000, percent=50):
    sizes, f = counted(rows)
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    explained = {
        (lang, part)
        for (lang, phrase), a in candidates.items() if len(phrase) == 3
        for part in (phrase[:2], phrase[1:]) if 100 * a >= percent * f[lang, part]
    }
    by_lang = {}
    for (lang, phrase), a in candidates.items():
        if (lang, phrase) in explained:
            continue
        score, _, l, r = min(
            (10**6 * a * a // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k, f[lang, phrase[:k]], f[lang, phrase[k:]])
            for k in range(1, len(phrase))
        )
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score)
        for lang, found in by_lang.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1)
    )


def found(spark, rows, **parameters):
    df = spark.createDataFrame([(i, lang, text) for i, (lang, text) in enumerate(rows)], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in collocations(df, **parameters).collect())


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(4)
    words = ["a", "B", "b", "c", "dé", "É", "the", "of", "x\x1fy", "　", "z" * 40, " "]
    gaps = [" "] * 12 + ["  ", "\t", " \t ", ". ", ",", "\n", "\r\n", "\x0b", "\x0c", "!?", ";:"]
    rows = []
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "fr", None, "und", ""]), text))
    rows += [(None, None), ("fr", ""), ("en", " \t\n.,"), ("xx", "rare phrase only")]
    for top in (2000, 7):
        got = found(spark, rows, top=top)
        assert got == brute_force(rows, top=top) and got
    assert found(spark, rows, support=3, explained_percent=90, shards=2) == brute_force(rows, support=3, percent=90)


def test_support_ties_and_drops(spark):
    rows = [("en", "red fox. ")] * 9 + [("en", "blue sky"), ("en", "blue sky, blue sky")] * 5 + [("de", "eins zwei drei")] * 10
    rows += [("de", "eins zwei")] * 11 + [("de", "zwei drei vier funf")] * 30
    got = {(r[0], r[2]): r for r in found(spark, rows)}
    assert ("en", "red fox") not in got and got["en", "blue sky"][3:6] == (15, 15, 15)
    # 10 of 21 are in the longer phrase: it stays; zwei drei is nearly always inside zwei drei vier.
    assert ("de", "eins zwei") in got and ("de", "zwei drei") not in got
    assert list(got.values()) and brute_force(rows) == sorted(got.values())


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.lang, r.text) for r in odd_documents.collect()]
    assert sorted(tuple(r) for r in collocations(odd_documents).collect()) == brute_force(rows)
    assert collocations(no_documents).collect() == []


def test_every_shard_is_mined_at_a_lower_support(spark):
    # One occurrence in many documents each, dealt over all shards: no shard holds 10.
    rows = [("en", f"w{i} common pair w{i + 1}") for i in range(12)]
    got = found(spark, rows)
    assert [r[2] for r in got] == ["common pair"] and got == brute_force(rows)


def test_counts_do_not_trust_one_hash():
    keys = np.array([5, 7, 5, 5, 7, 5], dtype=np.uint64)
    others = np.array([1, 2, 1, 3, 2, 4], dtype=np.uint64)
    counts = Counter()
    for at, n in C._distinct(keys, others):
        for place, times in zip(at.tolist(), n.tolist()):
            counts[int(keys[place]), int(others[place])] += times
    assert counts == {(5, 1): 2, (5, 3): 1, (5, 4): 1, (7, 2): 2}


def test_texts_of_phrases():
    lang = np.zeros(1, dtype=np.int64)
    piece = C._Piece(np.frombuffer(b"a b  c\td. e f", dtype=np.uint8), np.array([0, 13]), lang, lang)
    assert piece.texts(piece.phrases(3), 3).to_pylist() == ["a b c", "b c d"]
    assert piece.texts(piece.phrases(2), 2).to_pylist() == ["a b", "b c", "c d", "e f"]


def test_products_beyond_64_bits(spark):
    n = 4 * 10**9
    rows = [("en", 0, None, 10**13), ("en", 1, "a", n + 3), ("en", 1, "b", n + 1), ("en", 2, "a b", n)]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    (row,) = scored_phrases(counts).collect()
    assert row.score == 10**6 * n * n // ((n + 3) * (n + 1)) and (row.l, row.r) == (n + 3, n + 1)


def test_counts_hold_all_frequent_phrases(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sizes, f = counted(rows)
    got = {(r.lang, r.phrase): r.n for r in phrase_counts(documents).where(F.col("words") > 0).collect()}
    assert got == {(lang, " ".join(phrase)): n for (lang, phrase), n in f.items() if n >= 10}
