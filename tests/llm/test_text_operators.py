"""Span removal, decontamination, packing, language, quality: odd rows and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarlens.llm import decontamination, language, quality, words
from bazaarlens.llm.decontamination import contamination, decontaminated
from bazaarlens.llm.packing import best_two_fit, packed_documents, token_sequences
from bazaarlens.llm.substrings import without_repeated_spans

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# Words

def test_words_and_their_hashes_do_not_depend_on_where_they_stand():
    texts = ["Ab cd", None, "", "cd  ab\tAB", "é à", "cd"]
    ((first, last, data, bounds),) = list(words.text_pieces(pa.array(texts)))
    assert (first, last) == (0, 6)
    data = words.LOWER[data]
    starts, ends, rows = words.find_words(data, bounds, words.NOT_BLANK)
    found = [data[s:e].tobytes().decode() for s, e in zip(starts, ends)]
    assert found == ["ab", "cd", "cd", "ab", "ab", "é", "à", "cd"]
    assert rows.tolist() == [0, 2, 2, 2, 5, 7, 8]
    hashes = words.hash_words(data, starts, ends)
    assert len(set(hashes.tolist())) == 4 and hashes[0] == hashes[3] == hashes[4] and hashes[1] == hashes[2]


def test_a_piece_is_at_least_a_row():
    column = pa.array(["x" * 50, "y" * 5, "z" * 5]).slice(0)
    assert [(a, b) for a, b, _, _ in words.text_pieces(column, 12)] == [(0, 1), (1, 3)]
    assert [(a, b) for a, b, _, _ in words.text_pieces(column.slice(1), 4)] == [(0, 1), (1, 2)]


# Spans

def passage(name, count, sentence=7):
    return " ".join(f"{name}{i}" + ("." if i % sentence == sentence - 1 else "") for i in range(count))


def test_passages_go_from_all_but_the_first(spark):
    shared = passage("shared", 70)
    rows = [(5, passage("five", 40) + " tail " + shared + " rest " + passage("more", 30)),
            (2, passage("two", 33) + "\n" + shared), (9, shared), (7, passage("seven", 60))]
    got = {r.doc_id: r for r in without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    texts = dict(rows)
    assert got[2].text == texts[2] and got[2].n_removed == 0
    assert got[7].text == texts[7]
    assert got[9].n_removed == 70 and got[9].text == ""
    # All of the passage but what its first and last sentence share with their surroundings.
    left = [w for w in got[5].text.split() if w.startswith("shared")]
    assert len(left) <= 14 and got[5].n_removed >= 56
    assert all(w in got[5].text.split() for w in texts[5].split() if not w.startswith("shared"))


def brute_spans(rows, sentences, run_words, ends):
    """Words that stay, by comparing word lists; ``ends`` tells which words end a sentence."""
    seen, gone = {}, {}
    for i, text in sorted(rows):
        split = text.encode().split()
        after = [k + 1 for k, last in enumerate(ends(text)) if last]
        begin = [0, *after[:-1]]
        found = []
        for u, a in enumerate(begin):
            found += [(a, after[v]) for v in range(u + sentences - 1, len(after)) if after[v] - a >= run_words][:1]
        last = [(a, len(split)) for a in begin[: len(begin) - sentences + 1] if len(split) - a >= run_words]
        for a, b in found + last[-1:]:
            run = tuple(w.lower() for w in split[a:b])
            if seen.setdefault(run, (i, a)) != (i, a):
                gone.setdefault(i, set()).update(range(a, b))
    return {i: len(gone.get(i, ())) for i, _ in rows}


def test_spans_equal_brute_force(spark):
    from bazaarlens.llm.substrings import sentence_ends

    def ends(text):
        ((_, _, data, bounds),) = list(words.text_pieces(pa.array([text])))
        data = words.LOWER[data]
        starts, stops, first = words.find_words(data, bounds, words.NOT_BLANK)
        return sentence_ends(data, starts, stops, first, words.hash_words(data, starts, stops), 8)

    rng = random.Random(8)
    bits = [passage(f"p{i}_", rng.randrange(5, 60), rng.randrange(2, 12)) for i in range(12)]
    rows = [(i, " ".join(rng.choice(bits) for _ in range(rng.randrange(1, 6)))) for i in range(60)]
    got = without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), run_words=15)
    assert {r.doc_id: r.n_removed for r in got.collect()} == brute_spans(rows, 3, 15, ends)


@pytest.mark.parametrize("sentence", [0, 3, 14])
def test_planted_passages_are_found_by_word_windows(spark, sentence):
    rng = random.Random(51 + sentence)

    def made(count):
        found = [rng.choice("abcdefgh") + str(rng.randrange(4000)) for _ in range(count)]
        return [w + ("." if sentence and rng.randrange(sentence) == 0 else "") for w in found]

    rows = []
    for i in range(300):
        shared = made(rng.randrange(51, 61)) if i % 10 else ["same", "word", "again"][: i % 4 or 1] * 60
        shared = shared[:60]
        rows += [(2 * i + k, " ".join(made(rng.randrange(20, 40)) + shared + made(rng.randrange(20, 40)))) for k in (0, 1)]
    got = {r.doc_id: r for r in without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    seen = set()
    for i, text in rows:
        split = text.split()
        windows = {tuple(split[a : a + 51]) for a in range(len(split) - 50)}
        if windows & seen:
            # At most a sentence at each end, and what is too short for another run, stays.
            assert got[i].n_removed >= 51 - 3 * 8, text
        seen |= windows


@pytest.mark.parametrize("key", [None, 7])
def test_texts_with_equal_short_hashes_are_told_apart(spark, key):
    shared, clean = passage("shared", 30) + " a7293", passage("other", 30) + " b41660"
    docs = spark.createDataFrame([(1, passage("shared", 30)), (key, shared), (key, clean)], "doc_id long, text string")
    assert len({r[0] for r in docs.where("text like '% %7293' or text like '%b41660'").select(F.hash("text")).collect()}) == 1
    got = {r.text: r.n_removed for r in without_repeated_spans(docs).collect() if r.doc_id == key}
    assert got[clean] == 0 and sum(got.values()) >= 28


def test_spans_of_odd_documents(odd_documents, no_documents):
    got = without_repeated_spans(odd_documents)
    assert got.columns == [c for c in odd_documents.columns if c != "n_words"] + ["n_words", "n_removed"]
    rows = got.select("doc_id", "text", "n_removed").collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_removed == 0 and by_id[2].text == "" and by_id[11].text == ""
    assert by_id[3].text is None and by_id[4].text == "" and by_id[5].text == " \n\t "
    assert [r.text for r in rows if r.doc_id == 9] == ["a b c"] * 2
    assert sorted((r.text is None, r.n_removed > 0) for r in rows if r.doc_id is None) == [(False, True), (True, False)]
    assert without_repeated_spans(no_documents).count() == 0
    assert by_id[12].text.endswith("tail") and len(by_id[12].text) < 1000 < len(by_id[6].text)


# Decontamination

ITEMS = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item here"), (3, None), (4, "..."),
         (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (None, "one two three four")]


def found_items(text, items, window=10):
    import re

    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))

    doc, hit, ids = split(text), set(), set()
    for item, content in items:
        w = split(content)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if size else 0):
            for at in range(len(doc) - size + 1):
                if item is not None and doc[at : at + size] == w[a : a + size]:
                    hit.update(range(at, at + size))
                    ids.add(str(item))
    return len(doc), len(hit), sorted(ids), bool(hit)


@pytest.mark.parametrize("per_pass", [1_000_000, 3])
def test_contamination_equals_brute_force(spark, monkeypatch, per_pass):
    monkeypatch.setattr(decontamination, "TOKENS_PER_PASS", per_pass)
    item = ITEMS[0][1]
    texts = [item, f"x {item.upper()}! y", "alpha beta gamma", "A short, item: here and short item here", "short item", None, "",
             " ".join(item.split()[1:]), " ".join(item.split()[3:]), f"{item} {item}", "mu " + " ".join(item.split()[:11]), "one two three four"]
    items = spark.createDataFrame([(i, t, "clash", 1) for i, t in ITEMS], "item_id long, text string, words string, token int")
    rows = list(enumerate(texts)) + [(None, item), (3, texts[3])]
    got = contamination(spark.createDataFrame(rows, "doc_id long, text string"), items)
    expected = [(i, *found_items(t, ITEMS)) for i, t in rows]
    assert sorted(map(str, (tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()))) == sorted(map(str, expected))


def test_decontamination_of_odd_documents(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "number 3 jumps over the lazy dog again the quick fox number")], "item_id long, text string")
    left = decontaminated(odd_documents, items)
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 3, 4, 5, 6, 7, 8, 9, 9, 10, 12, 13]
    assert contamination(odd_documents, items.limit(0)).where("contaminated").count() == 0
    assert contamination(odd_documents, items.limit(0)).count() == 16
    assert contamination(no_documents, items).count() == 0


# Packing

def packed_rows(df):
    return df.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset").collect()


def test_packing_keeps_all_ids(spark, odd_documents, no_documents):
    rows = packed_rows(packed_documents(odd_documents, TOKENIZER))
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = []
    for r in odd_documents.select("doc_id", "text").collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], dtype="<u4").tobytes()
            expected.append((r.doc_id, piece, start, len(part) // 4, zlib.crc32(part)))
    assert sorted(map(str, expected)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) == -(-sum(r.length for r in rows) // 4096)
    assert packed_documents(no_documents, TOKENIZER).count() == 0


def test_words_at_borders_of_the_tokenizer(spark):
    texts = ["it's  I'LL don't", "a<|endoftext|>b <|endoftext|>", "é é ́x", "x\x1cy\x85z w", "ＡＢＣ 12³ ½", "日本語 текст\r\nend", "'s 's's"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    got = {r.doc_id: np.frombuffer(r.ids, dtype="<u4").tolist() for r in packed_rows(packed_documents(df, TOKENIZER))}
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_sequences_hold_their_pieces_in_order(spark):
    df = spark.createDataFrame([(i, " ".join(["word"] * (i % 9))) for i in range(40)], "doc_id long, text string")
    packed = packed_documents(df, TOKENIZER, capacity=16).persist()
    sequences = {r.sequence_id: r for r in token_sequences(packed).collect()}
    for sequence, r in sequences.items():
        parts = sorted((p.offset, p.ids) for p in packed.where(F.col("sequence_id") == sequence).collect())
        assert r.ids == b"".join(p for _, p in parts) and r.length == len(r.ids) // 4 <= 16
    packed.unpersist()


def test_best_two_fit_replaces_the_smallest():
    # 6 and 3 leave a gap of 1; the 3 makes room for 2 and 2, which fill it.
    counts = np.zeros(11, dtype=np.int64)
    counts[[6, 3]] = 1
    counts[2] = 2
    assert best_two_fit(counts, 10) == [(1, [6, 2, 2]), (1, [3])]


def test_best_two_fit_places_everything_once():
    rng = np.random.default_rng(4)
    for capacity in (1, 7, 64, 500):
        counts = np.zeros(capacity + 1, dtype=np.int64)
        np.add.at(counts, rng.integers(1, capacity + 1, 3000), 1)
        bins = best_two_fit(counts, capacity)
        placed = np.zeros_like(counts)
        for times, lengths in bins:
            assert times > 0 and 0 < sum(lengths) <= capacity
            np.add.at(placed, lengths, times)
        assert (placed == counts).all()
    assert best_two_fit(np.zeros(5, dtype=np.int64), 4) == []


# Language

def test_languages_and_spans(spark, odd_documents, no_documents):
    rng = random.Random(2)
    sounds = {"aa": "ka lo mi tu".split(), "bb": "schr ung eit vern".split(), "ru": "про ста кро вле".split()}

    def text(lang, n=40):
        return " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["aa", "bb", "ru"] * 30)] + [(200, None, "aa"), (201, text("aa"), None)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "ru"]
    mixed = text("aa", 30) + ". " + text("bb", 50).upper() + " 12 " + text("ru", 20)
    asked = [(1, text("aa")), (2, text("ru")), (3, mixed), (4, "123 !?"), (5, None), (6, ""), (7, "—"), (1, text("bb"))]
    got = language.identified(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 8 and by_id[2].lang_pred == "ru" and by_id[2].score == 1.0
    assert sorted(r.lang_pred for r in got if r.doc_id == 1) == ["aa", "bb"]
    assert [(s["first"], s["after"], s["lang"]) for s in by_id[3].spans] == [(0, 30, "aa"), (30, 80, "bb"), (80, 100, "ru")]
    assert all((by_id[i].lang_pred, by_id[i].score, by_id[i].spans) == ("und", 0.0, []) for i in (4, 5, 6, 7))
    assert language.identified(odd_documents, model).count() == 16
    assert language.identified(no_documents, model).count() == 0
    nothing = language.train(odd_documents.limit(0))
    assert {r.lang_pred for r in language.identified(odd_documents, nothing).collect()} == {"und"}


def test_shortcut_gives_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(2000):
        scores = rng.normal(0, 4, (rng.integers(1, 25), rng.integers(1, 5)))
        scores[:, 0] += rng.choice([0, 2, 5])

        def worth(path):
            return scores[np.arange(len(path)), path].sum() - 6.0 * (path[1:] != path[:-1]).sum()

        assert abs(worth(language.viterbi(scores, 6.0)) - worth(language.best_path(scores, 6.0))) < 1e-9


def test_held_out_languages(spark):
    from bazaarlens.llm.queries import op7_language_id

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op7_language_id(spark, sf).where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


# Quality

def test_pairwise_part_by_the_sum_of_squares():
    rng = np.random.default_rng(1)
    n = 6 + len(quality.STRUCTURE)
    model = quality.FactorisationMachine(
        0.3, rng.normal(size=n), rng.normal(size=(n, 3)) / 3, np.zeros(len(quality.STRUCTURE)), np.ones(len(quality.STRUCTURE))
    )
    structure = rng.normal(size=(2, len(quality.STRUCTURE)))
    rows = (np.array([0, 0, 1]), np.array([1, 4, 5]), np.array([0.5, 0.2, 0.9]))
    got = model.score(rows, structure)
    for row in range(2):
        x = np.zeros(n)
        x[rows[1][rows[0] == row]] = rows[2][rows[0] == row]
        x[6:] = structure[row]
        total = 0.3 + model.linear @ x
        total += sum(model.factors[i] @ model.factors[j] * x[i] * x[j] for i in range(n) for j in range(i + 1, n))
        assert abs(got[row] - 1 / (1 + np.exp(-total))) < 1e-9


def test_held_out_quality(spark):
    from bazaarlens.llm.queries import op10_quality_classifier

    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op10_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and sum(r.quality == r.predicted for r in rows) >= 0.95 * len(rows)
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum(g > b for g in good for b in bad) >= 0.98 * len(good) * len(bad)


def test_quality_of_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (10, 0), (3, 0), (7, None), (99, 1), (None, 1), (8, 5)], "doc_id long, label int")
    model = quality.train(odd_documents, labels)
    got = quality.scored(odd_documents, model)
    assert sorted(got.columns) == sorted(odd_documents.columns)
    rows = got.select("doc_id", "text", "score").collect()
    assert len(rows) == 16 and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[1] == scores[2] and scores[1] > scores[10]
    assert quality.scored(no_documents, model).count() == 0
    one_label = quality.train(odd_documents, labels.where("label = 1"))
    assert {round(r.score, 6) for r in quality.scored(odd_documents, one_label).collect()} == {0.75}
    none = quality.train(odd_documents, labels.limit(0))
    assert {r.score for r in quality.scored(odd_documents.select("doc_id", "text"), none).collect()} == {0.5}
