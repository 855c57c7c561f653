"""The registered queries: reports and metrics over the proxy tables, and each operator alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazaarlens import operators as ops
from bazaarlens import plans, tune
from bazaarlens.functions import (
    cents,
    exact_mean,
    exact_ratio,
    from_cents,
    mean_days,
    money_mean,
    money_sum,
    month_label,
    month_of,
)
from bazaarlens.plans.building_blocks import Tables, active_orders, gross, order_reviews, product_categories
from bazaarlens.schemas import MONEY
from checks import loads, oracle
from checks.proxy_tables import ProxyTables, event_number, source

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type the oracle's last division gives."""
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema]
    )


def over_tables(report: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(report(ProxyTables(tune(spark), sf_dir)))

    return run


def over_files(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(query(tune(spark), sf_dir))

    return run


REPORTS = {
    "q01_monthly_revenue": plans.monthly_revenue,
    "q02_top_categories": plans.top_categories,
    "q03_delivery_by_state": plans.delivery_by_state,
    "q04_payment_breakdown": plans.payment_breakdown,
    "q05_top_sellers": plans.top_sellers,
    "q06_review_by_category": plans.review_by_category,
    "q07_state_volume": plans.state_volume,
    "q08_repeat_customers": plans.repeat_customers,
    "q09_status_breakdown": plans.status_breakdown,
    "q10_customer_clv": plans.customer_lifetime_value,
    "q10_clv_full": plans.customer_lifetime_value_full,
    "m01_category_share": plans.category_share,
    "m02_overall_delivery": plans.overall_delivery,
    "m03_seller_state_concentration": plans.seller_state_concentration,
    "m04_state_share": plans.state_share,
    "m05_clv_quartiles": plans.clv_quartiles,
    "m06_order_value_true": plans.order_value_true,
    "m06_seller_revenue_true": plans.seller_revenue_true,
}


def active_filter(t):
    delivered = F.col("order_delivered_customer_date")
    return active_orders(t["orders"]).filter(
        (F.col("order_status") == "delivered")
        & delivered.isNotNull()
        & (delivered <= F.col("order_estimated_delivery_date"))
    ).select("order_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date")


def inner_join_chain(t):
    return (
        t["order_items"]
        .join(t["orders"], "order_id")
        .join(t["products"], "product_id")
        .join(t["sellers"], "seller_id")
        .join(t["customers"], "customer_id")
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("item_rows"), money_sum(gross()).alias("gross"))
    )


def left_join_coalesce(t):
    per_product = t["order_items"].groupBy("product_id").agg(F.count(F.lit(1)).alias("item_rows"))
    labelled = per_product.join(product_categories(t), "product_id")
    return labelled.groupBy("category").agg(F.sum("item_rows").alias("item_rows"))


def fanout_join(t):
    """Items times reviews per order, from one row per order on each side."""
    items = t["order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_rows"), F.sum(cents(F.col("price"))).alias("price_cents")
    )
    reviews = order_reviews(t["order_reviews"]).select("order_id", "review_rows")
    repeats = F.coalesce("review_rows", F.lit(1))
    return items.join(reviews, "order_id", "left").select(
        "order_id",
        (F.col("item_rows") * repeats).alias("joined_rows"),
        (F.col("item_rows") * F.coalesce("review_rows", F.lit(0))).alias("pair_count"),
        from_cents(F.col("price_cents") * repeats).alias("repeated_price"),
    )


def two_distinct(t):
    return ops.count_distinct_each(t["order_items"], "seller_id", {"order_id": "orders", "product_id": "products"})


def exact_avg(t):
    return t["order_items"].groupBy("seller_id").agg(
        money_mean(F.col("price")).alias("mean_price"),
        exact_mean(F.col("order_item_id"), 1).alias("mean_line"),
        exact_ratio(money_sum(gross()), F.count_distinct("order_id"), 2, num_scale=2).alias("gross_per_order"),
    )


def _persons_with_orders(t):
    return t["orders"].join(t["customers"].select("customer_id", "customer_unique_id"), "customer_id").groupBy(
        "customer_unique_id"
    )


def elapsed_days(t):
    purchased = F.col("order_purchase_timestamp")
    return _persons_with_orders(t).agg(
        mean_days(purchased, F.col("order_delivered_customer_date"), 1).alias("mean_days"),
        F.datediff(F.to_date(F.max(purchased)), F.to_date(F.min(purchased))).alias("lifespan_days"),
    )


def conditional_count(t):
    score = F.col("review_score")
    return (
        t["order_reviews"]
        .groupBy(F.expr("order_id div 50").alias("order_block"))
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.sum(F.when(score == 5, 1).otherwise(0)).alias("five_stars"),
            F.sum(F.when(score <= 2, 1).otherwise(0)).alias("low_scores"),
            F.count_if(score.between(2, 4)).alias("middle_scores"),
        )
        .filter("reviews >= 30")
    )


def min_max_sort(t):
    purchased = F.col("order_purchase_timestamp")
    return (
        _persons_with_orders(t)
        .agg(
            F.min(purchased).alias("first_purchase"),
            F.max(purchased).alias("last_purchase"),
            F.count("order_id").alias("orders"),
        )
        .orderBy(F.col("orders").desc_nulls_first(), F.col("customer_unique_id").asc_nulls_last())
        .drop("orders")
    )


def _placed(rows: DataFrame) -> DataFrame:
    """A few sorted rows with the place of each, as they come."""
    numbered = rows.withColumn("_position", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("_position")).cast("long")
    return numbered.withColumn("place", place).drop("_position")


def _delivery_months(t):
    month = month_of(F.col("order_delivered_customer_date"))
    by_month = t["orders"].groupBy(month.alias("first_day")).agg(F.count(F.lit(1)).alias("orders"))
    return by_month.withColumn("month", month_label(F.col("first_day")))


def order_ascending(t):
    """Months of delivery in order, the NULL one last."""
    return _placed(_delivery_months(t).orderBy(F.col("first_day").asc_nulls_last()).select("month", "orders"))


def order_descending(t):
    """The same from the last month on, the NULL one first."""
    return _placed(_delivery_months(t).orderBy(F.col("first_day").desc_nulls_first()).select("month", "orders"))


def order_by_unreturned(t):
    """The segments report, sorted by an aggregate that it does not return."""
    return _placed(plans.repeat_customers(t)).select("place", "customer_segment", "customer_count")


def month_bucket(t):
    first_day = month_of(F.col("order_purchase_timestamp"))
    by_month = t["orders"].groupBy(first_day.alias("first_day")).agg(F.count(F.lit(1)).alias("orders"))
    return by_month.select(month_label(F.col("first_day")).alias("month"), "orders")


def lag_change(spark, sf_dir):
    by_day = (
        source(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("payment_day"))
        .agg(money_sum(F.col("value").cast(MONEY)).alias("paid"))
    )
    return ops.period_change(by_day, "payment_day", "paid", "previous_paid", "pct_change")


def share_of_total(t):
    by_line = t["order_items"].groupBy("order_item_id").agg(F.count(F.lit(1)).alias("item_rows"))
    return ops.share_of_total(by_line, "item_rows", "pct_of_items")


def ntile_global(spark, sf_dir):
    orders = source(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), "o_totalprice")
    return ops.ntile_global(orders, 7, "o_totalprice", ["order_id"], "tile").select("order_id", "tile")


def topk(t):
    def leaders(ranking: str, key: str, k: int) -> DataFrame:
        sums = t["order_items"].groupBy(key).agg(money_sum(F.col("price")).alias("amount"))
        top = ops.top_k(sums, "amount", [key], k)
        return top.select(F.lit(ranking).alias("ranking"), F.col(key).cast("string").alias("id"), "amount")

    return (
        leaders("categories", "product_id", 20)
        .union(leaders("sellers", "seller_id", 10))
        .union(leaders("orders", "order_id", 50))
    )


def dedup_keep_first(spark, sf_dir):
    lines = source(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    kept = ops.dedup_keep_first(lines, ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


def pk_violations(t):
    return ops.pk_violations(t["order_items"], ["order_id", "order_item_id"])


def fk_orphans(t):
    return ops.fk_orphans(t["orders"], "order_id", t["order_items"], "order_id")


def check_violations(spark, sf_dir):
    scored = source(spark, sf_dir, "events").select("event_id", (event_number() % 7).alias("score"))
    return ops.check_violations(scored, F.col("score").between(1, 5))


def null_counts(t):
    times = ["order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"]
    of_orders = ops.null_counts(t["orders"], times)
    return of_orders.union(ops.null_counts(t["products"], ["product_category_name"]))


def length_violations(spark, sf_dir):
    return ops.length_violations(source(spark, sf_dir, "part"), {"p_name": 10, "p_brand": 7}, ["p_partkey"])


OVER_TABLES = [
    active_filter, inner_join_chain, left_join_coalesce, fanout_join, two_distinct, exact_avg, elapsed_days,
    conditional_count, min_max_sort, order_ascending, order_descending, order_by_unreturned, month_bucket, share_of_total, topk, pk_violations, fk_orphans, null_counts,
]
OVER_FILES = [lag_change, ntile_global, dedup_keep_first, check_violations, length_violations]

QUERIES: dict[str, Query] = {
    **{name: over_tables(report) for name, report in REPORTS.items()},
    **{f.__name__: over_tables(f) for f in OVER_TABLES},
    **{f.__name__: over_files(f) for f in OVER_FILES},
    "load_csv_roundtrip": over_files(loads.load_csv_roundtrip),
    "load_text_roundtrip": over_files(loads.load_text_roundtrip),
    "load_null_marker": over_files(loads.load_null_marker),
    "load_strict": over_files(loads.load_strict),
    "load_lenient_reasons": over_files(loads.load_lenient_reasons),
    "load_audit": over_files(loads.count_tables),
    "load_refresh": over_files(loads.load_refresh),
    "load_stopped": over_files(loads.load_stopped),
    "load_fault_places": over_files(loads.load_fault_places),
    "load_first_in_file": over_files(loads.load_first_in_file),
}

ORACLE_SQL: dict[str, str] = {**oracle.REPORTS, **oracle.METRICS, **oracle.OPERATORS, **oracle.QUALITY, **oracle.LOADS}
