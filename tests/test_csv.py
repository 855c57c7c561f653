"""CSV extracts with everything that goes wrong in them."""

import datetime
import os
import subprocess
import sys
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from bazaarlens.schemas import BY_NAME
from bazaarlens.sources import read_csv_positional
from bazaarlens.sources import corrupt_rows, csv_files
from bazaarlens.sources.csv_files import CORRUPT, Unreadable, _lines_are_records, _splits

REVIEWS = BY_NAME["order_reviews"].schema
ITEMS = BY_NAME["order_items"].schema
GEO = BY_NAME["geolocation"].schema


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_quotes_breaks_nulls_and_bom(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        '﻿"a","b","c","d","e","f","g"\n'
        'r1,o1,5,"say ""hi"", all",,2018-01-18 00:00:00,\n'
        'r2,o2,1,"","two\nlines, ""quoted""\n\nend",2018-01-19 00:00:00,2018-01-20 10:56:33\n'
        "r3,o3,3,t,m,,\n",
    )
    assert not _lines_are_records(_splits(spark, path))
    rows = {r.review_id: r for r in read_csv_positional(spark, path, REVIEWS).collect()}
    assert list(rows) and set(rows) == {"r1", "r2", "r3"}
    assert rows["r1"].review_comment_title == 'say "hi", all'
    assert rows["r1"].review_comment_message is None
    assert rows["r2"].review_comment_title == ""
    assert rows["r2"].review_comment_message == 'two\nlines, "quoted"\n\nend'
    assert rows["r2"].review_answer_timestamp == datetime.datetime(2018, 1, 20, 10, 56, 33)
    assert rows["r3"].review_creation_date is None


def test_single_line_file_reads_the_same(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        '﻿"a","b","c","d","e","f","g"\r\n'
        'r1,o1,5,"say ""hi"", all",,2018-01-18 00:00:00,\r\n'
        'r2,o2,1,"",m,2018-01-19 00:00:00,2018-01-20 10:56:33\r\n',
    )
    assert _lines_are_records(_splits(spark, path))
    rows = {r.review_id: r for r in read_csv_positional(spark, path, REVIEWS).collect()}
    assert rows["r1"].review_comment_title == 'say "hi", all' and rows["r1"].review_comment_message is None
    assert rows["r2"].review_comment_title == ""
    assert rows["r2"].review_answer_timestamp == datetime.datetime(2018, 1, 20, 10, 56, 33)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("split_bytes", [64, 257, 4096])
def test_records_cross_splits(spark, tmp_path, newline, split_bytes):
    """Files cut every few bytes give the rows that were written, whatever lies on the border."""
    messages = {}
    for number in range(60):
        text = newline.join(f'line {i} of {number}, ""q""' for i in range(number % 7))
        messages[f"r{number}"] = text
    for part in range(2):
        lines = ["a,b,c,d,e,f,g"]
        for name, text in messages.items():
            lines.append(f'{name}-{part},o,5,t,"x{text}",2018-01-18 00:00:00,')
        (tmp_path / f"part{part}.csv").write_bytes((newline.join(lines) + newline).encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_csv_positional(spark, [str(tmp_path / f"part{p}.csv") for p in range(2)], REVIEWS).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    expected = {f"{n}-{p}": "x" + t.replace('""', '"') for n, t in messages.items() for p in range(2)}
    assert {r.review_id: r.review_comment_message for r in rows} == expected
    assert len(rows) == 120


# Each case is read twice: as it is, and with a further record whose field holds a line break, which takes
# the other reader.
CASES = {
    "quoted and unquoted empty": ('r1,o1,5,"",,,', [("r1", "", None)]),
    "quotes and commas": ('r1,o1,5,"say ""hi"", all",m,,', [("r1", 'say "hi", all', "m")]),
    "a line of spaces": ("r1,o1,5,t,m,,\n   \nr2,o1,5,t,m,,", [("r1", "t", "m"), ("r2", "t", "m")]),
    "empty lines": ("\n\nr1,o1,5,t,m,,\n\n", [("r1", "t", "m")]),
    "a tab and a carriage return": ("r1,o1,5,t,m,,\r\n\t\r\nr2,o1,5,t,m,,\r", [("r1", "t", "m"), ("r2", "t", "m")]),
    "spaces around values": ("r1,o1,5, t ,m ,,", [("r1", " t ", "m ")]),
    "no line break at the end": ("r1,o1,5,t,é,,", [("r1", "t", "é")]),
    "only quotes": ('r1,o1,5,"""","""""",,', [("r1", '"', '""')]),
}


@pytest.mark.parametrize("joined", [False, True])
@pytest.mark.parametrize("bom", ["", "\ufeff"])
@pytest.mark.parametrize("case", CASES)
def test_both_readers_agree(spark, tmp_path, case, bom, joined):
    text, expected = CASES[case]
    more = 'zz,o1,5,t,"two\nlines",,\n' if joined else ""
    path = write(tmp_path / "r.csv", f"{bom}a,b,c,d,e,f,g\n{more}{text}")
    assert _lines_are_records(_splits(spark, path)) is not joined
    rows = read_csv_positional(spark, path, REVIEWS).collect()
    got = sorted((r.review_id, r.review_comment_title, r.review_comment_message) for r in rows)
    assert got == sorted(expected + ([("zz", "t", "two\nlines")] if joined else []))


def test_a_record_over_many_splits(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(300))
    path = write(tmp_path / "r.csv", f'a,b,c,d,e,f,g\nr1,o,5,t,"{long}",,\nr2,o,5,t,m,,\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_csv_positional(spark, path, REVIEWS).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {r.review_id: r.review_comment_message for r in rows} == {"r1": long, "r2": "m"}


def test_reader_needs_the_package_on_the_driver_only(tmp_path):
    """Run from another folder: the workers cannot import the package."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    write(tmp_path / "r.csv", 'a,b,c,d,e,f,g\nr1,o1,5,t,"two\nlines",,\n')
    script = f"""
import sys
sys.path.insert(0, {package!r})
from bazaarlens import build_session
from bazaarlens.schemas import BY_NAME
from bazaarlens.sources import read_csv_positional
spark = build_session("elsewhere", "local[2]", spark_sql_warehouse_dir={str(tmp_path / "w")!r})
print([r.review_comment_message for r in read_csv_positional(spark, {str(tmp_path / "r.csv")!r}, BY_NAME["order_reviews"].schema).collect()])
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=170)
    assert "['two\\nlines']" in done.stdout, done.stderr[-2000:]


def test_types_keep_zeros_and_round_half_up(spark, tmp_path):
    geo = write(tmp_path / "g.csv", "a,b,c,d,e\n01037,-23.54562128115268,-46.63929204800168,sao paulo,SP\n")
    row = read_csv_positional(spark, geo, GEO).first()
    assert row.geolocation_zip_code_prefix == "01037"
    assert row.geolocation_lat == Decimal("-23.54562128115268")
    items = write(tmp_path / "i.csv", "a,b,c,d,e,f,g\no,1,p,s,2017-09-19 09:45:35,1.005,2.994\n")
    row = read_csv_positional(spark, items, ITEMS).first()
    assert (row.price, row.freight_value) == (Decimal("1.01"), Decimal("2.99"))


BAD_ROWS = {
    "30 February": "o,1,p,s,2018-02-30 00:00:00,1.00,1.00",
    "short row": "o,1,p,s",
    "long row": "o,1,p,s,2018-02-20 00:00:00,1.00,1.00,more",
    "70000 in a short": "o,70000,p,s,2018-02-20 00:00:00,1.00,1.00",
    "amount too large": "o,1,p,s,2018-02-20 00:00:00,12345678901.00,1.00",
}


@pytest.mark.parametrize("text_field", ["p", '"p\nq"'])
@pytest.mark.parametrize("case", BAD_ROWS)
def test_bad_rows_fail_or_are_kept_apart(spark, tmp_path, case, text_field):
    good = f"o,2,{text_field},s,2018-02-20 00:00:00,1.00,1.00"
    path = write(tmp_path / "i.csv", f"a,b,c,d,e,f,g\n{good}\n{BAD_ROWS[case]}\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD"):
        read_csv_positional(spark, path, ITEMS).collect()
    rows = read_csv_positional(spark, path, ITEMS, strict=False).collect()
    assert [r[CORRUPT] for r in rows if r[CORRUPT]] == [BAD_ROWS[case]]
    assert [r.order_item_id for r in rows if not r[CORRUPT]] == [2]
    assert [r[CORRUPT] for r in corrupt_rows(spark, path, ITEMS).collect()] == [BAD_ROWS[case]]


def test_unterminated_field_is_refused(spark, tmp_path):
    path = write(tmp_path / "i.csv", 'a,b,c,d,e,f,g\no,1,"p,s,2018-02-20 00:00:00,1.00,1.00\n')
    with pytest.raises(ValueError, match="unterminated"):
        read_csv_positional(spark, path, ITEMS)


@pytest.mark.parametrize("joined", [False, True])
def test_marks_in_texts_stay(spark, tmp_path, joined):
    """The sign that stands for a quoted empty field while reading may be a value itself."""
    more = 'zz,o1,5,t,"two\nlines",,\n' if joined else ""
    path = write(tmp_path / "r.csv", f'a,b,c,d,e,f,g\n{more}r1,o1,5,\x01,\x01\x01,,\nr2,o1,5,"",,,\n')
    rows = {r.review_id: r for r in read_csv_positional(spark, path, REVIEWS).collect()}
    assert (rows["r1"].review_comment_title, rows["r1"].review_comment_message) == ("\x01", "\x01\x01")
    assert (rows["r2"].review_comment_title, rows["r2"].review_comment_message) == ("", None)


def test_unterminated_field_says_where(spark, tmp_path):
    path = write(tmp_path / "i.csv", 'a,b,c,d,e,f,g\no,1,"p\nq",s,2018-02-20 00:00:00,1.00,1.00\no,2,"p,s\nx,\n')
    with pytest.raises(Unreadable) as raised:
        read_csv_positional(spark, path, ITEMS)
    assert raised.value.line == 4 and raised.value.file.endswith("i.csv")


def test_stray_quotes_do_not_join_a_whole_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_files, "LONGEST_RECORD", 2000)
    lines = "\n".join("o,1,p,s,2018-02-20 00:00:00,1.00,1.00" for _ in range(4000))
    path = write(tmp_path / "i.csv", f'a,b,c,d,e,f,g\no,1,"p,s\n{lines}\no,2,p",s\n')
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        with pytest.raises(Exception, match="more than 2000 bytes begins in line 2"):
            read_csv_positional(spark, path, ITEMS).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines_are_counted_without_a_sort(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    plans = []
    store = csv_files.materialize
    monkeypatch.setattr(csv_files, "materialize", lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or store(rows))
    csv_files._splits(spark, str(tmp_path / "a.csv"))
    assert len(plans) == 1 and "HashAggregate" in plans[0] and "Sort" not in plans[0]


@pytest.mark.parametrize("line, kept", [("a\r", "a"), ("a\r\r", "a"), ("a\rb", "a\rb"), (" \x00\t", None), ("\u00a0", "\u00a0"), ("", None), (" b", " b")])
def test_returns_and_blank_lines(spark, line, kept):
    rows = spark.createDataFrame([(line,)], "value string").select(csv_files._record("value").alias("record"))
    assert [r.record for r in rows.filter(csv_files._is_record()).collect()] == ([] if kept is None else [kept])
