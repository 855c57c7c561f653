"""Row sets shared by several reports.

They lean on the table keys (one row per order id, customer id, product id, ...), which a strict
load enforces. What is joined on an order id is brought to one row per order first wherever the
report allows it: that shrinks the shuffle before it starts and takes the weight off hot orders.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.functions import cents

Tables = Mapping[str, DataFrame]

# The statuses that do not count as sales, and the name for products without one.
INACTIVE_STATUSES = ("canceled", "unavailable")
NO_CATEGORY = "Uncategorized"


def gross() -> Column:
    return F.col("price") + F.col("freight_value")


def active_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("order_status").isin(*INACTIVE_STATUSES))


def order_totals(items: DataFrame) -> DataFrame:
    """One row per order: the gross value of its items in cents, and their number."""
    return items.groupBy("order_id").agg(
        F.sum(cents(gross())).alias("gross_cents"), F.count(gross()).alias("item_rows")
    )


def order_reviews(reviews: DataFrame) -> DataFrame:
    """One row per reviewed order: what its reviews add to any group the order falls in."""
    score = F.col("review_score")
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("review_rows"),
        F.count(score).alias("scores"),
        F.sum(score).alias("score_sum"),
        F.count_if(score == 5).alias("five_stars"),
        F.count_if(score <= 2).alias("low_scores"),
    )


def product_categories(tables: Tables) -> DataFrame:
    """One row per product with the name its category is reported under.

    The translation is a short list, but its length is not taken on trust: no hint is given, so
    it is broadcast when its measured size allows and sort-merged otherwise.
    """
    translated = tables["products"].join(
        tables["product_category_name_translation"], "product_category_name", "left"
    )
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit(NO_CATEGORY))
    return translated.select("product_id", category.alias("category"))


def priced_orders(tables: Tables) -> DataFrame:
    """One row per active order that has items: its customer, purchase time, gross and items."""
    orders = active_orders(tables["orders"]).select("order_id", "customer_id", "order_purchase_timestamp")
    return orders.join(order_totals(tables["order_items"]), "order_id")
