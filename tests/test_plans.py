"""What the plans must look like for tables that fit no single machine."""

import re

import pytest

from bazaarlens import plans, session
from bazaarlens.operators import fk_orphans, ranking
from bazaarlens.schemas import TABLES
from bazaarlens.sources import csv_files, loading
from checks.registry import QUERIES, REPORTS

SF_DIR = "/root/testdata/sf0.001"
LOADS = {name for name in QUERIES if name.startswith("load_")}
# Parts of these run early; their plans are taken where the rows are stored.
STORED = {"q10_clv_full", "m05_clv_quartiles", "ntile_global", *LOADS}


# Explicit broadcasts by what is in them: hash buckets found hot (fewer than 2^14), sort partitions
# with their offsets (at most the number of shuffle partitions), file splits (as many as scan tasks) and files, keys
# that break a rule (counted to be at most 100,000).
BOUNDED = ("_slices", "_before", "open", "first(path", "_set")


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast: only explicit hints are left."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan_of(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def line_depth(line):
    return len(re.match(r"[\s:|+\-]*", line).group())


def subtree(lines, start):
    depth = line_depth(lines[start])
    end = start + 1
    while end < len(lines) and line_depth(lines[end]) > depth:
        end += 1
    return lines[start:end]


@pytest.fixture
def stored_plans(monkeypatch):
    """The plans of all rows that are stored while a query is put together."""
    plans_of_stored = []

    def spy(df):
        plans_of_stored.append(plan_of(df))
        return session.materialize(df)

    for module in (ranking, csv_files, loading):
        monkeypatch.setattr(module, "materialize", spy)
    return plans_of_stored


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairs_and_no_rows_through_one_task(no_broadcast, stored_plans, name):
    last = plan_of(QUERIES[name](no_broadcast, SF_DIR))
    assert bool(stored_plans) is (name in STORED - {"load_audit"})
    for plan in [*stored_plans, last]:
        lines = plan.split("\n")
        assert not [line for line in lines if "NestedLoop" in line or "Cartesian" in line]
        for number, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # Only aggregated rows may be brought into one partition.
                below = subtree(lines, number)
                assert any("HashAggregate" in child or "SortAggregate" in child for child in below[1:5]), "\n".join(below[:6])
            if "BroadcastExchange" in line:
                assert any(word in "".join(subtree(lines, number)[1:5]) for word in BOUNDED), line


def test_orphans_meet_one_row_per_parent_key(no_broadcast):
    parents = no_broadcast.createDataFrame([(1,)] * 50 + [(2,)], "id int")
    children = no_broadcast.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    found = fk_orphans(children, "k", parents, "id")
    lines = plan_of(found).split("\n")
    (join,) = [n for n, line in enumerate(lines) if "Join" in line]
    sides = [n for n, line in enumerate(lines) if n > join and "HashAggregate(keys=[reference" in line and "partial" not in line]
    assert len(sides) >= 2
    assert [tuple(r) for r in found.collect()] == [(3, 2)]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LOADS))
def test_no_python_in_the_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_reports_broadcast_nothing_by_themselves(no_broadcast):
    for name in sorted(set(REPORTS) - STORED):
        lines = plan_of(QUERIES[name](no_broadcast, SF_DIR)).split("\n")
        assert not [line for line in lines if "BroadcastExchange" in line]


def test_scans_read_only_the_columns_in_use(spark):
    plan = plan_of(QUERIES["q09_status_breakdown"](spark, SF_DIR))
    assert re.findall(r"ReadSchema: (\S+)", plan) == ["struct<o_orderstatus:string,o_orderpriority:string>"]
    plan = plan_of(QUERIES["q01_monthly_revenue"](spark, SF_DIR))
    assert "l_shipdate" not in plan and "l_partkey" not in plan


def test_filters_reach_the_scan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # show them whole
    tables = {}
    for table in TABLES:
        spark.createDataFrame([], table.schema).write.parquet(f"{tmp_path}/{table.name}")
        tables[table.name] = spark.read.schema(table.schema).parquet(f"{tmp_path}/{table.name}")
    delivered = plan_of(plans.delivery_by_state(tables))
    assert "EqualTo(order_status,delivered)" in delivered
    assert "IsNotNull(order_delivered_customer_date)" in delivered
    for report in (plans.monthly_revenue, plans.top_categories, plans.state_volume, plans.repeat_customers):
        assert "Not(In(order_status, [canceled,unavailable]))" in plan_of(report(tables))
    lean = plan_of(plans.monthly_revenue(tables))
    assert "struct<order_id:string,price:decimal(10,2),freight_value:decimal(10,2)>" in lean
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_items_are_summed_before_they_are_shuffled(no_broadcast):
    lines = plan_of(QUERIES["q01_monthly_revenue"](no_broadcast, SF_DIR)).split("\n")
    shuffles = [n for n, line in enumerate(lines) if "Exchange hashpartitioning(order_id" in line]
    assert any("partial_sum" in "".join(subtree(lines, n)[1:3]) for n in shuffles)


@pytest.mark.parametrize("name", ["q05_top_sellers", "m03_seller_state_concentration", "two_distinct"])
def test_distinct_counts_copy_no_rows(no_broadcast, name):
    plan = plan_of(QUERIES[name](no_broadcast, SF_DIR))
    assert "Expand" not in plan
    lines = plan.split("\n")
    # Hot sellers are spread over their pairs with products, which are summed up before the shuffle.
    pairs = [n for n, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\((seller_id|_1), product_id", line)]
    assert pairs and all("partial" in lines[n + 1] or "HashAggregate" in lines[n + 1] for n in pairs)


def test_quartiles_store_two_columns(spark, stored_plans):
    QUERIES["m05_clv_quartiles"](spark, SF_DIR)
    assert "first_order_date" not in stored_plans[0] and "order_purchase_timestamp" not in stored_plans[0].split("Sort [")[1][:200]


def test_top_reports_sort_no_whole_result(spark):
    for name in ("q02_top_categories", "q05_top_sellers"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, SF_DIR))
