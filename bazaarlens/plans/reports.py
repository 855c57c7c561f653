"""The ten business reports, and the lifetime value report without its limit.

Ratios that look odd are the reports' definitions and kept: an "order value" averaged over items
or payments, seller revenue counted once per review. ``metrics`` has the corrected forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

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
from bazaarlens.operators import (
    bucketize,
    ntile_global,
    ntile_of_top,
    period_change,
    share_of_total,
    top_k,
)
from bazaarlens.plans.building_blocks import (
    Tables,
    active_orders,
    order_reviews,
    priced_orders,
    product_categories,
)

# Report sizes, the least number of reviews, and the segments with their labels.
TOP_CATEGORIES = 20
TOP_SELLERS = 10
TOP_CUSTOMERS = 50
MIN_REVIEWS = 30
CLV_TILES = 4
SEGMENTS = (
    (1, 1, "1 – One-time buyer"),
    (2, 2, "2 – Repeat (2 orders)"),
    (3, 5, "3-5 – Loyal"),
    (6, None, "6+ – VIP"),
)


def monthly_revenue(tables: Tables) -> DataFrame:
    """Gross revenue per purchase month and its change from the month before."""
    by_month = (
        priced_orders(tables)
        .groupBy(month_of(F.col("order_purchase_timestamp")).alias("first_day"))
        .agg(from_cents(F.sum("gross_cents")).alias("revenue"))
    )
    changed = period_change(by_month, "first_day", "revenue", "prev_month_revenue", "mom_pct_change")
    return changed.orderBy(F.col("first_day").asc_nulls_last()).select(
        month_label(F.col("first_day")).alias("month"), "revenue", "prev_month_revenue", "mom_pct_change"
    )


def category_sales(tables: Tables) -> DataFrame:
    """Orders, revenue and mean item price of every category, unsorted."""
    orders = active_orders(tables["orders"]).select("order_id")
    return (
        tables["order_items"]
        .select("order_id", "product_id", "price")
        .join(orders, "order_id")
        .join(product_categories(tables), "product_id")
        .groupBy("category")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money_sum(F.col("price")).alias("total_revenue"),
            money_mean(F.col("price")).alias("avg_item_price"),
        )
    )


def top_categories(tables: Tables) -> DataFrame:
    """The categories with the highest item revenue."""
    return top_k(category_sales(tables), "total_revenue", ["category"], TOP_CATEGORIES)


def delivered_orders(tables: Tables) -> DataFrame:
    return tables["orders"].filter(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    )


def delivery_measures() -> list:
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return [
        F.count("order_id").alias("delivered_orders"),
        mean_days(purchased, delivered, 1).alias("avg_delivery_days"),
        mean_days(delivered, estimated, 1).alias("avg_days_early_vs_estimate"),
    ]


def delivered_with_customer(tables: Tables) -> DataFrame:
    """Delivered orders with the state they went to."""
    customers = tables["customers"].select("customer_id", "customer_state")
    return delivered_orders(tables).join(customers, "customer_id")


def delivery_by_state(tables: Tables) -> DataFrame:
    """Mean days to delivery, and ahead of the estimate, per customer state."""
    by_state = delivered_with_customer(tables).groupBy("customer_state").agg(*delivery_measures())
    return by_state.orderBy(
        F.col("avg_delivery_days").asc_nulls_last(), F.col("customer_state").asc_nulls_last()
    )


def payment_breakdown(tables: Tables) -> DataFrame:
    """Orders, revenue and instalments per payment type.

    The mean value is per payment, and an order paid in two ways counts in both types and twice
    in the total the shares refer to.
    """
    by_type = (
        tables["order_payments"]
        .groupBy("payment_type")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money_sum(F.col("payment_value")).alias("total_revenue"),
            money_mean(F.col("payment_value")).alias("avg_order_value"),
            exact_mean(F.col("payment_installments"), 1).alias("avg_installments"),
        )
    )
    shares = share_of_total(by_type, "total_orders", "pct_of_orders")
    return shares.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("payment_type").asc_nulls_last())


def seller_sales(tables: Tables) -> DataFrame:
    """Orders, products, revenue and mean review score of every seller, unsorted.

    Joining items to reviews row by row repeats an item once per review of its order. Here the
    reviews are counted per order first and the item's price multiplied, which is the same sum
    from one row per item. Sellers are joined once their sums exist.

    Orders and products are counted without a copy of the rows for each: the first item of a seller in an order stands
    for the order, and is found where the order lies. Then only pairs of seller and product are shuffled, summed up.

    The item number, a small integer and part of the key, bounds the items of an order, so the join
    by order needs no care for hot orders and runs without a shuffle on bucketed tables.
    """
    orders = active_orders(tables["orders"]).select("order_id")
    reviews = order_reviews(tables["order_reviews"]).select("order_id", "review_rows", "scores", "score_sum")
    items = tables["order_items"].select("order_id", "product_id", "seller_id", "price")
    sold = items.join(orders.join(reviews, "order_id", "left"), "order_id")
    repeats = F.coalesce("review_rows", F.lit(1))
    # Rows lie by order since the join, so this costs a sort and no shuffle.
    in_order = F.row_number().over(Window.partitionBy("order_id", "seller_id").orderBy("product_id"))
    by_product = (
        sold.withColumn("repeats", repeats)
        .withColumn("first", in_order == 1)
        .groupBy("seller_id", "product_id")
        .agg(
            F.count_if("first").alias("orders"),
            F.sum(cents(F.col("price")) * F.col("repeats")).alias("revenue"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("scores").alias("scores"),
        )
    )
    by_seller = by_product.groupBy("seller_id").agg(
        F.sum("orders").alias("total_orders"),
        F.count("product_id").alias("unique_products"),
        from_cents(F.sum("revenue")).alias("total_revenue"),
        exact_ratio(F.sum("score_sum"), F.sum("scores"), 2).alias("avg_review_score"),
    )
    return tables["sellers"].select("seller_id", "seller_city", "seller_state").join(by_seller, "seller_id")


def top_sellers(tables: Tables) -> DataFrame:
    """The sellers with the highest revenue, items counted once per review of their order."""
    return top_k(seller_sales(tables), "total_revenue", ["seller_id"], TOP_SELLERS)


def review_by_category(tables: Tables) -> DataFrame:
    """Review scores per category over all pairs of a review and an item of its order.

    The pairs are never built: each item carries its order's review counts and sums, and these
    are added up per product before the products' categories are looked up. Orders are not read:
    every load checks that items and reviews refer to one.
    """
    reviewed = order_reviews(tables["order_reviews"].filter(F.col("review_score").isNotNull()))
    items = tables["order_items"].select("order_id", "product_id")
    measures = ["scores", "score_sum", "five_stars", "low_scores"]
    by_product = (
        items.join(reviewed, "order_id")
        .groupBy("product_id")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    by_category = (
        by_product.join(product_categories(tables), "product_id")
        .groupBy("category")
        .agg(
            F.sum("scores").alias("total_reviews"),
            exact_ratio(F.sum("score_sum"), F.sum("scores"), 2).alias("avg_review_score"),
            F.sum("five_stars").alias("five_star_count"),
            F.sum("low_scores").alias("low_score_count"),
        )
        .filter(F.col("total_reviews") >= MIN_REVIEWS)
    )
    return by_category.orderBy(F.col("avg_review_score").desc_nulls_first(), F.col("category").asc_nulls_last())


def state_sales(tables: Tables) -> DataFrame:
    """Orders, persons, gross revenue and items of every customer state, unsorted.

    Two steps, first per state and person, so that persons are counted without a second copy of
    the rows and a hot state is spread over its persons.
    """
    customers = tables["customers"].select("customer_id", "customer_unique_id", "customer_state")
    by_person = (
        priced_orders(tables)
        .join(customers, "customer_id")
        .groupBy("customer_state", "customer_unique_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.sum("gross_cents").alias("gross_cents"),
            F.sum("item_rows").alias("item_rows"),
        )
    )
    return by_person.groupBy("customer_state").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_unique_id").alias("unique_customers"),
        from_cents(F.sum("gross_cents")).alias("total_revenue"),
        F.sum("item_rows").alias("item_rows"),
    )


def state_volume(tables: Tables) -> DataFrame:
    """Orders, persons and gross revenue per customer state; the mean value is per item."""
    return (
        state_sales(tables)
        .withColumn("avg_order_value", exact_ratio(F.col("total_revenue"), F.col("item_rows"), 2, num_scale=2))
        .drop("item_rows")
        .orderBy(F.col("total_orders").desc_nulls_first(), F.col("customer_state").asc_nulls_last())
    )


def repeat_customers(tables: Tables) -> DataFrame:
    """Persons by their number of active orders."""
    orders = active_orders(tables["orders"]).select("order_id", "customer_id")
    customers = tables["customers"].select("customer_id", "customer_unique_id")
    by_person = (
        orders.join(customers, "customer_id")
        .groupBy("customer_unique_id")
        .agg(F.count("order_id").alias("order_count"))
    )
    by_segment = by_person.groupBy(bucketize(F.col("order_count"), SEGMENTS).alias("customer_segment")).agg(
        F.count(F.lit(1)).alias("customer_count"), F.min("order_count").alias("least_orders")
    )
    shares = share_of_total(by_segment, "customer_count", "pct_of_customers")
    return shares.orderBy("least_orders").drop("least_orders")


def status_breakdown(tables: Tables) -> DataFrame:
    """Orders per status."""
    by_status = tables["orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))
    shares = share_of_total(by_status, "order_count", "pct_of_total")
    return shares.orderBy(F.col("order_count").desc_nulls_first(), F.col("order_status").asc_nulls_last())


def customer_values(tables: Tables) -> DataFrame:
    """One row per person: orders, value and first and last purchase; the mean is per item."""
    customers = tables["customers"].select("customer_id", "customer_unique_id")
    purchased = F.col("order_purchase_timestamp")
    value = from_cents(F.sum("gross_cents"))
    by_person = (
        priced_orders(tables)
        .join(customers, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            value.alias("lifetime_value"),
            exact_ratio(value, F.sum("item_rows"), 2, num_scale=2).alias("avg_order_value"),
            F.to_date(F.min(purchased)).alias("first_order_date"),
            F.to_date(F.max(purchased)).alias("last_order_date"),
        )
    )
    return by_person.withColumn("customer_lifespan_days", F.datediff("last_order_date", "first_order_date"))


def customer_lifetime_value(tables: Tables) -> DataFrame:
    """The persons with the highest value; the quartile is among all persons."""
    return ntile_of_top(
        customer_values(tables), CLV_TILES, "lifetime_value", ["customer_unique_id"], "clv_quartile", TOP_CUSTOMERS
    )


def customer_lifetime_value_full(tables: Tables) -> DataFrame:
    """All persons with their value and quartile, highest value first."""
    ranked = ntile_global(
        customer_values(tables), CLV_TILES, "lifetime_value", ["customer_unique_id"], "clv_quartile"
    )
    return ranked.orderBy(F.col("lifetime_value").desc_nulls_first(), F.col("customer_unique_id").asc_nulls_last())
