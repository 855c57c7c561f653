"""Token counts and alignment against the tokenizers' own libraries."""

import hashlib
import os
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from bazaarlens.llm import token_counts as counts_module
from bazaarlens.llm import tokens
from bazaarlens.llm.alignment import aligned_tokens
from bazaarlens.llm.token_counts import token_counts

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "b", "é", " ", "  ", "\n", "\t", " ", "　", "▁", "\x85", "\x1c", "\x00", "'s", "'", ".", "1", "<|endoftext|>",
       "<s>", "</s>", "<unk>", "<0x41>", "中", "​", "﻿", "\r", "\U0001f600", "the", " of", "́", "ﬁ", "", "͸"]


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, "", " ", "a" * 5000, " " * 3000]


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(BYTES)
    model.encode_special_tokens = True
    return model, sentencepiece.SentencePieceProcessor(model_file=PIECES)


# Tokenizers

def test_byte_level_ids_are_those_of_the_library(library, odd_texts, monkeypatch):
    texts = [t for t in odd_texts if t] + [f"a{c}b 1{c}2 {c} .{c}, {c}{c}" for c in map(chr, range(1, 0x3000))]
    expected = [e.ids for e in library[0].encode_batch(texts, add_special_tokens=False)]
    assert tokens.byte_tokenizer(BYTES).encoded(texts) == expected
    monkeypatch.setattr(tokens, "PART_CHARS", 5)
    assert tokens.byte_tokenizer(BYTES).encoded(texts) == expected


def test_long_texts_may_be_cut(library, odd_texts, monkeypatch):
    texts = [t or "" for t in odd_texts]
    monkeypatch.setattr(tokens, "PART_CHARS", 5)
    assert tokens.tokenizer(PIECES).encoded(texts) == library[1].encode(texts)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        tokens.byte_tokenizer(WORDS)


def test_versions_differ_by_file_and_library(monkeypatch):
    first = tokens.version_digest(PIECES)
    assert first == tokens.version_digest(PIECES) != tokens.version_digest(BYTES)
    monkeypatch.setattr(tokens, "version", lambda name: "0")
    assert tokens.version_digest(PIECES) != first


# Token counts

def rows_of(df):
    return sorted((r.doc_id is not None, r.doc_id, r.n_bytes, r.n_tokens) for r in df.collect())


def expected_counts(rows, encode):
    return sorted((i is not None, i, len((t or "").encode()), len(encode(t or ""))) for i, t in rows)


def test_counts_of_odd_texts_and_the_cache(spark, library, odd_texts, tmp_path, monkeypatch):
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    df = spark.createDataFrame(rows + rows[:50], "doc_id long, text string").repartition(4)
    cache = str(tmp_path / "cache")
    assert rows_of(token_counts(df, cache, PIECES)) == expected_counts(rows + rows[:50], library[1].encode)
    folder = f"{cache}/{tokens.version_digest(PIECES)}"
    assert spark.read.parquet(f"{folder}/*").count() == len({t or "" for t in odd_texts})

    # Nothing new, nothing encoded; then only what is new, once; another tokenizer has counts of its own.
    def refuse(*_):
        raise AssertionError("encoded again")

    with monkeypatch.context() as patched:
        patched.setattr(counts_module, "_encode", refuse)
        assert rows_of(token_counts(df.limit(40), cache, PIECES)) and len(os.listdir(folder)) == 1
    more = spark.createDataFrame([(1, "new one"), (2, "new one"), (3, odd_texts[0]), (4, None)], "doc_id long, text string")
    got = rows_of(token_counts(more, cache, PIECES))
    assert got == expected_counts([(1, "new one"), (2, "new one"), (3, odd_texts[0]), (4, None)], library[1].encode)
    assert spark.read.parquet(f"{folder}/*").count() == len({t or "" for t in odd_texts}) + 1
    words = Tokenizer.from_file(WORDS)
    other = rows_of(token_counts(more, cache, WORDS))
    assert other == expected_counts([(1, "new one"), (2, "new one"), (3, odd_texts[0]), (4, None)], lambda t: words.encode(t, add_special_tokens=False).ids)
    assert len(os.listdir(cache)) == 2


def test_stored_counts_are_used_and_may_repeat(spark, tmp_path):
    folder = tmp_path / tokens.version_digest(PIECES)
    text = "a b c"
    planted = [(bytearray(hashlib.sha256(text.encode()).digest()), 77)]
    for name in ("one", "two"):
        spark.createDataFrame(planted, "content binary, n_tokens long").write.parquet(f"{folder}/{name}")
    df = spark.createDataFrame([(1, text), (None, text)], "doc_id long, text string")
    assert [r.n_tokens for r in token_counts(df, str(tmp_path), PIECES).collect()] == [77, 77]


def test_counts_of_odd_documents(spark, library, odd_documents, no_documents, tmp_path):
    got = token_counts(odd_documents, str(tmp_path / "c"), PIECES)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "content"]
    key = lambda r: tuple((x is not None, x) for x in r)
    expected = [(r.doc_id, len((r.text or "").encode()), len(library[1].encode(r.text or ""))) for r in odd_documents.collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()), key=key) == sorted(expected, key=key)
    assert token_counts(no_documents, str(tmp_path / "d"), PIECES).collect() == []
    assert not os.path.exists(tmp_path / "d")


def test_query_counts_whole_tables(spark, library):
    from bazaarlens.llm.queries import op12_token_counts

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op12_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        i: (len(t.encode()), n := len(library[1].encode(t)), n > 4096) for i, t in texts.items()
    }
    assert len(got) == len(texts)


# Alignment

def plain_alignment(rows, library):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) by running over byte offsets."""
    byte_model, piece_model = library
    value = {char: byte for byte, char in enumerate(tokens._byte_chars())}
    found, links = [], Counter()
    for i, text in rows:
        a = byte_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece_model.encode(text) if text else []
        a_bytes = [bytes(value[c] for c in byte_model.id_to_token(x)) for x in a]
        b_bytes = [
            bytes([int(piece_model.id_to_piece(x)[3:5], 16)]) if piece_model.is_byte(x) else piece_model.id_to_piece(x).replace("▁", " ").encode()
            for x in b
        ]
        if text is None or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            a, b = [], []
        ends, at = {}, 0
        for place, token in enumerate(a_bytes if a else []):
            at += len(token)
            ends[at] = place
        at, linked, groups, from_a, from_b = 0, [], [], 0, 0
        for place, token in enumerate(b_bytes if b else []):
            at += len(token)
            if at in ends:
                linked.append((a[ends[at]], b[place]))
                groups.append(",".join(map(str, a[from_a : ends[at] + 1])) + "|" + ",".join(map(str, b[from_b : place + 1])))
                from_a, from_b = ends[at] + 1, place + 1
        links.update(linked)
        found.append((i, len(a), len(b), groups, linked))
    highest = Counter()
    for (_, b), n in links.items():
        highest[b] = max(highest[b], n)
    return [
        (i, n_a, n_b, len(groups), len(linked), sum(links[p] == highest[p[1]] for p in linked), sum(links[p] for p in linked),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for i, n_a, n_b, groups, linked in found
    ]


def key(row):
    return tuple((x is not None, x) for x in row)


def test_alignment_equals_a_plain_one(spark, library, odd_texts, monkeypatch):
    rows = [(i, t) for i, t in enumerate(odd_texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, aligned_tokens(df, BYTES, PIECES).collect()), key=key)
    expected = sorted(plain_alignment(rows, library), key=key)
    assert got == expected
    # Texts with the sign that stands for a space, and empty ones, have no tokens.
    none = {i for i, n_a, *_ in got if n_a == 0}
    assert none == {i for i, t in rows if not t or "▁" in t}


def test_alignment_of_odd_documents(spark, library, odd_documents, no_documents):
    got = aligned_tokens(odd_documents, BYTES, PIECES)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_alignment(rows, library), key=key)
    assert aligned_tokens(no_documents, BYTES, PIECES).collect() == []
    blank = odd_documents.where("text is null or text = ''")
    assert {r.groups_sha256 for r in aligned_tokens(blank, BYTES, PIECES).collect()} == {""}


def test_query_aligns_whole_tables(spark, library):
    from bazaarlens.llm.queries import op13_tokenizer_alignment

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op13_tokenizer_alignment(spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_alignment(rows, library))


def test_pairs_of_several_chunks_are_counted_together(spark, library, monkeypatch):
    from bazaarlens.llm import alignment

    rows = [(i, f"same words here {i % 3}") for i in range(40)]
    one = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    stored = [alignment._sides(BYTES, PIECES)]
    found, pairs, sizes = alignment._documents(stored[0], [t for _, t in rows])
    assert len(found) == 40 and sizes.sum() == len(pairs)
    assert sorted(map(tuple, aligned_tokens(one, BYTES, PIECES).collect())) == sorted(plain_alignment(rows, library))
