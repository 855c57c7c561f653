"""Every corpus query that has SQL, against it on the same whole tables."""

import os

import duckdb
import pytest

from bazaarlens.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def sortable(row):
    return tuple((value is not None, str(value)) for value in row)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((list(row) for row in df.select(*columns).collect()), key=sortable)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(([row[names.index(c)] for c in columns] for row in result.fetchall()), key=sortable)
    assert got == expected
    assert [type(v) for v in got[0] if v is not None] == [type(v) for v in expected[0] if v is not None]


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
