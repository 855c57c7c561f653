"""Headline figures quoted beside the reports, and corrected forms of their loose averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions import cents, exact_ratio, from_cents, money_mean, money_sum
from bazaarlens.operators import ntile_global, running_share, share_of_total
from bazaarlens.plans.building_blocks import Tables, active_orders, order_reviews
from bazaarlens.plans.reports import (
    CLV_TILES,
    category_sales,
    customer_values,
    delivered_orders,
    delivery_measures,
    state_sales,
    top_sellers,
)


def category_share(tables: Tables) -> DataFrame:
    """Every category's share of item revenue, and of it and all larger ones together."""
    sales = category_sales(tables).select("category", "total_revenue")
    shares = share_of_total(sales, "total_revenue", "pct_of_revenue", scale=2)
    running = running_share(shares, "total_revenue", "category", "running_pct", scale=2)
    return running.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category").asc_nulls_last())


def overall_delivery(tables: Tables) -> DataFrame:
    """Mean days to delivery, and ahead of the estimate, over the whole country: one row.

    Customers are not read: every load checks that an order refers to one.
    """
    return delivered_orders(tables).agg(*delivery_measures())


def seller_state_concentration(tables: Tables) -> DataFrame:
    """Where the top sellers sit."""
    by_state = (
        top_sellers(tables)
        .groupBy("seller_state")
        .agg(F.count(F.lit(1)).alias("sellers"), money_sum(F.col("total_revenue")).alias("total_revenue"))
    )
    return by_state.orderBy(F.col("sellers").desc(), F.col("seller_state").asc_nulls_last())


def state_share(tables: Tables) -> DataFrame:
    """Every customer state's share of the orders."""
    shares = share_of_total(
        state_sales(tables).select("customer_state", "total_orders"), "total_orders", "pct_of_orders"
    )
    return shares.orderBy(F.col("total_orders").desc(), F.col("customer_state").asc_nulls_last())


def clv_quartiles(tables: Tables) -> DataFrame:
    """Persons and mean value per quartile, with the mean over all persons.

    Persons are ranked, and so stored, with nothing but their value.
    """
    value = F.col("lifetime_value")
    persons = customer_values(tables).select("customer_unique_id", "lifetime_value")
    by_quartile = (
        ntile_global(persons, CLV_TILES, "lifetime_value", ["customer_unique_id"], "clv_quartile")
        .groupBy("clv_quartile")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            money_sum(value).alias("total_value"),
            money_mean(value).alias("avg_lifetime_value"),
        )
    )
    all_rows = Window.partitionBy()
    overall = exact_ratio(
        F.sum("total_value").over(all_rows), F.sum("customers").over(all_rows), 2, num_scale=2
    )
    return by_quartile.withColumn("avg_lifetime_value_all", overall).orderBy("clv_quartile")


def order_value_true(tables: Tables) -> DataFrame:
    """Gross value per order beside the per-item mean that the state report calls order value."""
    total = F.col("total_revenue")
    return (
        state_sales(tables)
        .select(
            "customer_state",
            "total_orders",
            exact_ratio(total, F.col("item_rows"), 2, num_scale=2).alias("avg_item_value"),
            exact_ratio(total, F.col("total_orders"), 2, num_scale=2).alias("avg_order_value"),
        )
        .orderBy(F.col("customer_state").asc_nulls_last())
    )


def seller_revenue_true(tables: Tables) -> DataFrame:
    """Every seller's revenue beside the figure that counts an item once per review."""
    orders = active_orders(tables["orders"]).select("order_id")
    reviews = order_reviews(tables["order_reviews"]).select("order_id", "review_rows")
    items = tables["order_items"].select("order_id", "seller_id", "price")
    sold = items.join(orders.join(reviews, "order_id", "left"), "order_id")
    repeats = F.coalesce("review_rows", F.lit(1))
    by_seller = sold.groupBy("seller_id").agg(
        money_sum(F.col("price")).alias("revenue"),
        from_cents(F.sum(cents(F.col("price")) * repeats)).alias("reported_revenue"),
    )
    return tables["sellers"].select("seller_id").join(by_seller, "seller_id")
