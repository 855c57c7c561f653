"""Operators against plain forms of the same thing, on awkward rows."""

import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from bazaarlens.functions import elapsed_seconds, exact_mean, exact_ratio, mean_days, month_label, month_of, percent
from bazaarlens.operators import (
    bucketize,
    check_violations,
    count_distinct_each,
    dedup_keep_first,
    fk_orphans,
    length_violations,
    ntile_global,
    ntile_of_top,
    null_counts,
    period_change,
    pk_violations,
    rank_global,
    share_of_total,
    spread_join,
    top_k,
)
from bazaarlens.plans.reports import SEGMENTS


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def plain_ntile(df, tiles):
    order = Window.orderBy(F.col("v").desc_nulls_first(), F.col("id").asc_nulls_last())
    return df.withColumn("tile", F.ntile(tiles).over(order))


@pytest.fixture(params=["true", "false"], ids=["merged partitions", "eight partitions"])
def partitions(spark, request):
    """Small results end up in one partition unless Spark is told to leave them apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


CASES = {
    "distinct": [(i, (i * 37) % 1009) for i in range(1000)],
    "ties": [(i, i % 5) for i in range(997)],
    "all equal": [(i, 1) for i in range(103)],
    "one value in a third": [(i, 7 if i % 3 == 0 else i) for i in range(500)],
    "nulls": [(i, None if i % 4 == 0 else i % 11) for i in range(201)],
    "ten": [(i, i) for i in range(10)],
    "three": [(i, i) for i in range(3)],
    "one": [(1, 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_ntile_global_equals_ntile(spark, partitions, case):
    df = spark.createDataFrame(CASES[case], "id int, v int").repartition(7)
    got = ntile_global(df, 4, "v", ["id"], "tile")
    assert got.columns == ["id", "v", "tile"]
    assert {(r.id, r.tile) for r in got.collect()} == {(r.id, r.tile) for r in plain_ntile(df, 4).collect()}


@pytest.mark.parametrize("k", [1, 5, 50])
@pytest.mark.parametrize("case", CASES)
def test_ntile_of_top_equals_ntile_then_limit(spark, case, k):
    df = spark.createDataFrame(CASES[case], "id int, v int").repartition(5)
    expected = plain_ntile(df, 4).orderBy(F.col("v").desc_nulls_first(), "id").limit(k)
    assert [tuple(r) for r in ntile_of_top(df, 4, "v", ["id"], "tile", k).collect()] == [
        tuple(r) for r in expected.collect()
    ]


def test_ten_rows_in_four_tiles(spark):
    df = spark.createDataFrame(CASES["ten"], "id int, v int")
    tiles = ntile_global(df, 4, "v", ["id"], "tile").orderBy(F.desc("v")).collect()
    assert [r.tile for r in tiles] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


def test_ntile_of_no_rows(spark):
    df = spark.createDataFrame([], "id int, v int")
    assert ntile_global(df, 4, "v", ["id"], "tile").count() == 0
    assert ntile_of_top(df, 4, "v", ["id"], "tile", 5).count() == 0


def test_rank_global_is_a_row_number(spark, partitions):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 101).alias("v")).repartition(9)
    got = rank_global(df, "v", ["id"], "rank", "total")
    expected = df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("v"), "id")))
    assert {(r.id, r.rank) for r in got.collect()} == {(r.id, r.rank) for r in expected.collect()}
    assert {r.total for r in got.select("total").distinct().collect()} == {5000}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("min_slice_rows", [5, 100, 10_000])
def test_spread_join_equals_join(spark, how, min_slice_rows):
    """A third of the rows on one key, NULL keys, keys only on one side."""
    generator = random.Random(7)
    rows = [(i, 1 if i % 3 == 0 else None if i % 17 == 0 else generator.randrange(40)) for i in range(3000)]
    left = spark.createDataFrame(rows, "row_id int, key int")
    right = spark.createDataFrame([(k, k * 10) for k in range(30)] + [(99, 1)], "key int, value int")
    got = spread_join(left, right, "key", ["row_id"], how, min_slice_rows)
    expected = left.join(right, "key", how)
    assert got.columns == expected.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)


def test_spread_join_cuts_the_hot_key(spark):
    left = spark.range(30_000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("key"))
    right = spark.range(30_000).select(F.col("id").alias("key"), F.col("id").alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = spread_join(left, right, "key", ["row_id"], min_slice_rows=500)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in per_task) == joined.count() == 30_000
        assert max(r["count"] for r in per_task) < 8_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_spread_join_refuses_other_joins(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        spread_join(df, df, "k", ["k"], "full")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3) | st.none(), st.integers(0, 9)), min_size=1, max_size=40), st.integers(1, 6))
def test_dedup_leaves_the_least_row_of_each_key(spark, rows, partitions):
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(partitions)
    last = 10**6
    expected = {}
    for row in rows:
        order = (last if row[1] is None else row[1], row[2])
        if row[0] not in expected or order < expected[row[0]][0]:
            expected[row[0]] = (order, row)
    got = dedup_keep_first(df, ["k"], ["a", "b"]).collect()
    assert sorted(tuple(str(v) for v in r) for r in got) == sorted(tuple(str(v) for v in r) for _, r in expected.values())


def test_dedup_drops_copies_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    plan = dedup_keep_first(df, ["k"], ["a"])._jdf.queryExecution().executedPlan().toString()
    first_stage = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in first_stage and "Partial" in first_stage


def test_period_change(spark):
    rows = [(None, "9.00"), (5, "0.00"), (3, "10.00"), (1, "8.00"), (6, "7.00")]
    df = spark.createDataFrame([(p, Decimal(v)) for p, v in rows], "p int, v decimal(10,2)")
    got = period_change(df, "p", "v", "prev", "pct").orderBy(F.col("p").asc_nulls_last()).collect()
    assert [(r.p, r.prev and str(r.prev), r.pct is not None and str(r.pct)) for r in got] == [
        (1, None, False),
        (3, "8.00", "25.00"),
        (5, "10.00", "-100.00"),
        (6, Decimal("0.00"), False),
        (None, "7.00", "28.57"),
    ]


def test_shares_sum_to_the_whole(spark):
    df = spark.createDataFrame([(i, i * i + 1) for i in range(8)], "g int, n long")
    shares = [r.pct for r in share_of_total(df, "n", "pct").collect()]
    assert abs(sum(shares) - 100) <= Decimal("0.04")


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(50, None)], "id int, v int").repartition(4)
    assert [r.id for r in top_k(df, "v", ["id"], 4).collect()] == [50, 1, 3, 5]


def test_segments(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 5, 6, 60)], "n int")
    got = [r[0] for r in df.select(bucketize(F.col("n"), SEGMENTS)).collect()]
    assert got == [
        "1 – One-time buyer", "2 – Repeat (2 orders)", "3-5 – Loyal", "3-5 – Loyal", "6+ – VIP", "6+ – VIP",
    ]
    assert all("–" in label for label in got)


def test_means_round_half_away_from_zero(spark):
    df = spark.createDataFrame([("1.00",), ("1.01",)], "t string").select(F.col("t").cast("decimal(10,2)").alias("v"))
    mean = exact_mean(F.col("v"), 2, scale=2)
    assert df.agg(mean).first()[0] == Decimal("1.01")
    assert df.select((-F.col("v")).alias("v")).agg(mean).first()[0] == Decimal("-1.01")
    assert df.filter("v > 5").agg(mean).first()[0] is None


def test_ratio_does_not_round_twice(spark):
    # 1.0049999999996 would become 1.005 and then 1.01 if it were cut to a few digits first.
    df = spark.createDataFrame([(10049999999996, 10**13)], "n long, d long")
    assert df.select(exact_ratio(F.col("n"), F.col("d"), 2)).first()[0] == Decimal("1.00")
    assert df.select(exact_ratio(F.col("n"), F.lit(0), 2)).first()[0] is None
    assert df.select(percent(F.lit(1), F.lit(3), 2)).first()[0] == Decimal("33.33")


def test_ratio_takes_all_digits_of_both_sides(spark):
    df = spark.sql("select cast('123456789012345678901234567890.12' as decimal(38,2)) n, 10000000000000000000000 d")
    df = df.select("n", F.col("d").cast("decimal(38,0)").alias("d"))
    assert df.select(exact_ratio(F.col("n"), F.col("d"), 2, num_scale=2)).first()[0] == Decimal("12345678.90")
    signs = spark.createDataFrame([(5, 2), (-5, 2), (5, -2), (-5, -2), (0, 3)], "n long, d long")
    assert [r[0] for r in signs.select(exact_ratio(F.col("n"), F.col("d"), 0)).collect()] == [3, -3, -3, 3, 0]


def test_mean_of_more_than_ten_to_the_eighteen_seconds(spark):
    rows = spark.range(4_000_000).select(
        F.lit("0001-01-01 00:00:00").cast("timestamp_ntz").alias("a"), F.lit("9999-12-31 12:00:00.000001").cast("timestamp_ntz").alias("b")
    )
    total = rows.agg(F.sum(elapsed_seconds(F.col("a"), F.col("b")).cast("long"))).first()[0]
    assert total > 10**18
    assert rows.agg(mean_days(F.col("a"), F.col("b"), 1)).first()[0] == Decimal("3652058.5")


def test_no_decimal_wider_than_eight_bytes_per_row(spark):
    df = spark.sql("select timestamp_ntz'2017-10-14 12:00:00' a, timestamp_ntz'2017-10-15 12:00:00.5' b")
    assert dict(df.select(elapsed_seconds(F.col("a"), F.col("b")).alias("s")).dtypes)["s"] == "decimal(18,6)"
    assert df.agg(mean_days(F.col("a"), F.col("b"), 1)).first()[0] == Decimal("1.0")


def test_small_integer_mean_is_a_decimal(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "n short")
    assert df.agg(exact_mean(F.col("n"), 1)).first()[0] == Decimal("1.7")


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_time_ignores_the_session_zone(spark, zone):
    """A clock change in the zone makes no day shorter and moves no month."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2017-10-14 12:00:00' a, timestamp_ntz'2017-10-15 12:00:00.5' b")
        row = df.select(
            elapsed_seconds(F.col("a"), F.col("b")), elapsed_seconds(F.col("b"), F.col("a")), month_label(month_of(F.col("a")))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (row[0], row[1], row[2]) == (Decimal("86400.500000"), Decimal("-86400.500000"), "2017-10")


def test_quality_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 0), (None, "b", None), (2, "a", 9)], "k int, t string, n int"
    )
    assert {tuple(r) for r in pk_violations(df, ["k", "t"]).collect()} == {(1, "a", 2), (None, "b", 1)}
    parents = spark.createDataFrame([(1,)], "id int")
    assert rows_of(fk_orphans(df, "k", parents, "id")) == [(2, 1)]
    assert sorted(r.n for r in check_violations(df, F.col("n").between(1, 5)).collect()) == [0, 9]
    assert rows_of(null_counts(df, ["k", "t", "n"])) == [("k", 1), ("n", 1), ("t", 0)]
    words = spark.createDataFrame([(1, "abc", "é"), (2, "abcd", None)], "id int, x string, y string")
    assert rows_of(length_violations(words, {"x": 3, "y": 1}, ["id"])) == [(2, "x", 4, 3)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"])), max_size=25))
def test_distinct_counts_of_several_columns(spark, rows):
    df = spark.createDataFrame(rows, "g int, x int, y string")
    expected = {g: (len({x for k, x, _ in rows if k == g and x is not None}), len({y for k, _, y in rows if k == g and y is not None})) for g, _, _ in rows}
    got = count_distinct_each(df, "g", {"x": "xs", "y": "ys"})
    assert got.columns == ["g", "xs", "ys"]
    assert {r.g: (r.xs, r.ys) for r in got.collect()} == expected
