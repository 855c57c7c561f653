"""Every registered query against its SQL on the same tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks.registry import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def sortable(row):
    return tuple((value is not None, str(value)) for value in row)


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(([plain(v) for v in row] for row in df.select(*columns).collect()), key=sortable)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = sorted(([row[i] for i in places] for row in result.fetchall()), key=sortable)
    assert got, "an empty result checks nothing"
    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected):
        assert mine == theirs
    assert [type(v) for v in got[0] if v is not None] == [type(v) for v in expected[0] if v is not None]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert ORACLE_SQL.items() <= entry.oracle_sql().items()


def test_flagship_query_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "revenue", "prev_month_revenue", "mom_pct_change"]
    assert df.count() == 80


# The columns that each report is sorted by, in turn; "-" for descending with NULLs first, else
# ascending with NULLs last. q08 is sorted by what it does not return: order_by_unreturned checks it.
SORTED_BY = {
    "q01_monthly_revenue": ["month"],
    "q02_top_categories": ["-total_revenue", "category"],
    "q03_delivery_by_state": ["avg_delivery_days", "customer_state"],
    "q04_payment_breakdown": ["-total_revenue", "payment_type"],
    "q05_top_sellers": ["-total_revenue", "seller_id"],
    "q06_review_by_category": ["-avg_review_score", "category"],
    "q07_state_volume": ["-total_orders", "customer_state"],
    "q09_status_breakdown": ["-order_count", "order_status"],
    "q10_customer_clv": ["-lifetime_value", "customer_unique_id"],
    "q10_clv_full": ["-lifetime_value", "customer_unique_id"],
}


@pytest.mark.parametrize("name", sorted(SORTED_BY))
def test_report_comes_in_its_order(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    expected = list(rows)
    for key in reversed(SORTED_BY[name]):
        column, down = key.removeprefix("-"), key.startswith("-")
        missing = [r for r in expected if r[column] is None]
        present = sorted((r for r in expected if r[column] is not None), key=lambda r: -r[column] if down else r[column])
        expected = missing + present if down else present + missing
    assert rows == expected and len(rows) > 1
