"""Every stage of the pipeline on whole small tables, against brute force over what it was given."""

import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from bazaarlens.llm import words
from bazaarlens.llm.decontamination import clean_texts
from bazaarlens.llm.minhash import one_row_of_each_group
from bazaarlens.llm.substrings import sentence_ends
from test_near_duplicates import brute_force
from test_text_operators import brute_spans, found_items

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents, then what each stage wrote."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return found


def test_bad_documents_go_and_good_ones_stay(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1]}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert sum(i not in kept for i in bad) >= 0.95 * len(bad)


def test_one_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1]]
    components = brute_force(rows, 5, 80)
    assert sorted(r.doc_id for r in steps[2]) == sorted(i for i, c in components.items() if i == c)


def test_repeated_spans_go(steps):
    def ends(text):
        ((_, _, data, bounds),) = list(words.text_pieces(pa.array([text])))
        data = words.LOWER[data]
        starts, stops, first = words.find_words(data, bounds, words.NOT_BLANK)
        return sentence_ends(data, starts, stops, first, words.hash_words(data, starts, stops), 8)

    def split(text):
        return text.encode().split()  # at ASCII white space, as the operator does

    before = {r.doc_id: r.text for r in steps[2]}
    removed = brute_spans([(i, t) for i, t in before.items() if split(t)], 3, 28, ends)
    after = {r.doc_id: r for r in steps[3]}
    for i, text in before.items():
        left = len(split(text)) - removed.get(i, 0)
        if left == 0 and removed.get(i):
            assert i not in after
        else:
            assert len(split(after[i].text)) == left
            assert after[i].text == text if not removed.get(i) else after[i].n_chars == len(after[i].text)


def test_leaks_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = sorted(r.doc_id for r in steps[3] if not found_items(r.text, items)[3])
    assert sorted(r.doc_id for r in steps[4]) == clean


def test_sequences_hold_all_that_is_left(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in steps[5]:
        pieces.setdefault(r.doc_id, {})[r.piece] = np.frombuffer(r.ids, dtype="<u4").tolist()
    got = {i: [x for piece in sorted(parts) for x in parts[piece]] for i, parts in pieces.items()}
    assert got == {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in steps[4]}
    filled = {}
    for r in sorted(steps[5], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096


def test_rows_are_judged_by_their_own_text(spark):
    rng = np.random.default_rng(6)
    one, two, three, four = (" ".join(f"w{x}" for x in rng.integers(0, 10**6, 40)) for _ in range(4))
    items = spark.createDataFrame([(1, " ".join(two.split()[5:25]))], "item_id long, text string")
    rows = [(None, one), (None, one), (5, one), (5, one), (9, two), (9, three), (None, two), (None, four), (None, four), (None, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, `a.b` string").repartition(3)
    kept = one_row_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        map(str, [(5, one), (9, two), (9, three), (None, four), (None, None), (3, "")])
    )
    clean = clean_texts(docs, items)
    assert clean.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in clean.collect()))) == sorted(map(str, (r for r in rows if r[1] != two)))


def test_registered(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"
    ]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in entry.oracle_sql()


@pytest.fixture
def odd_folder(spark, tmp_path):
    """Benchmark and labels for stages that are given odd documents."""
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (10, 0)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_names(spark, odd_documents, no_documents, odd_folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_documents.withColumns({"n_removed": F.lit(5), "a.b": F.lit(1), "_hash": F.lit("h"), "n_words": F.lit(77)})
    result = stage(spark, docs, odd_folder)
    assert stage(spark, docs.limit(0), odd_folder).count() == 0
    if name == "best_fit_packing":
        assert result.where("doc_id = 9").count() == 2 and result.where("doc_id is null").count() == 2
        return
    assert result.columns == docs.columns
    rows = result.collect()
    assert rows
    # What was there under the operators' own names is there still.
    given = {(r.doc_id, r.score, r.n_removed, r.n_words, r["a.b"], r._hash, r.spans) for r in docs.collect()}
    kept = {(r.doc_id, r.score, r.n_removed, r.n_words, r["a.b"], r._hash, r.spans) for r in rows}
    assert kept <= given


def test_stages_without_labels_or_benchmark(spark, odd_documents, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for stage in (corpus_pipeline.keep_good, corpus_pipeline.remove_benchmark_leaks):
        assert stage(spark, odd_documents, str(tmp_path)).count() == odd_documents.count()


def test_run_leaves_its_last_stage_only(spark):
    import os

    from bazaarlens.session import shared_folder

    before = set(os.listdir(shared_folder(spark)))
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    (folder,) = [f for f in set(os.listdir(shared_folder(spark))) - before if f.startswith("corpus-")]
    assert os.listdir(f"{shared_folder(spark)}/{folder}") == ["best_fit_packing"]


def test_other_queries_stay_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    for name in [n for n in sys.modules if n.startswith("bazaarlens.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    names = set(entry.queries())
    assert "q01_monthly_revenue" in names and not any(n.startswith("op") for n in names)
    assert set(entry.oracle_sql()) <= names


def test_training_rows_are_bounded_whatever_repeats(spark):
    from bazaarlens.llm import quality

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, "x y z"), (3, "q r s")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    collected = []
    frame = type(docs)
    to_arrow = frame.toArrow
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(frame, "toArrow", lambda self: collected.append(to_arrow(self)) or collected[-1])
        quality.train(docs, labels)
    assert [table.num_rows for table in collected] == [3]
