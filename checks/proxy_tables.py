"""The marketplace tables as views over the driver's order tables (see FIXTURES.md).

Every view reads whole tables. ``checks.oracle`` states the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.schemas import MONEY

ESTIMATE_DAYS = 365

Read = Callable[[str], DataFrame]


# The driver's columns, declared so that opening a file starts no job.
SOURCE_COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_number() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


class ProxyTables(Mapping):
    """Table name to view; files are opened for the views a query asks for, and only then."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._read = lru_cache(maxsize=None)(lambda name: source(spark, sf_dir, name))

    def __getitem__(self, name: str) -> DataFrame:
        return VIEWS[name](self._read)

    def __iter__(self):
        return iter(VIEWS)

    def __len__(self) -> int:
        return len(VIEWS)


def _category() -> Column:
    return F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string"))


def _translation(read: Read) -> DataFrame:
    names = read("part").filter("p_size <= 30").select(_category().alias("product_category_name")).distinct()
    return names.withColumn("product_category_name_english", F.lower("product_category_name"))


def _customers(read: Read) -> DataFrame:
    """One customer per order, as in the real extracts; a person is a customer key in a year."""
    return (
        read("orders")
        .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("customer_id"),
            (F.col("o_custkey") * 10000 + F.year("o_orderdate")).alias("customer_unique_id"),
            F.col("n_name").alias("customer_state"),
        )
    )


def _sellers(read: Read) -> DataFrame:
    return (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"),
        )
    )


def _products(read: Read) -> DataFrame:
    return read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") != 50, _category()).alias("product_category_name"),
    )


def _order_items(read: Read) -> DataFrame:
    return read("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast(MONEY).alias("price"),
        F.col("l_quantity").cast(MONEY).alias("freight_value"),
    )


def _order_payments(read: Read) -> DataFrame:
    return read("events").select(
        F.col("user_id").alias("order_id"),
        F.col("event_id").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        (event_number() % 12 + 1).alias("payment_installments"),
        F.col("value").cast(MONEY).alias("payment_value"),
    )


def _order_reviews(read: Read) -> DataFrame:
    return read("events").select(
        F.col("event_id").alias("review_id"),
        F.expr("event_id div 2").alias("order_id"),
        (event_number() % 5 + 1).alias("review_score"),
    )


def _orders(read: Read) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderpriority") == "1-URGENT", "canceled")
        .when(F.col("o_orderpriority") == "2-HIGH", "unavailable")
        .otherwise("processing")
    )
    # The first shipment not before the order; a view that does not ask for it does not read lines.
    first_shipment = (
        read("orders")
        .select("o_orderkey", "o_orderdate")
        .join(read("lineitem"), (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate")))
        .groupBy("o_orderkey")
        .agg(F.min("l_shipdate").alias("shipped"))
    )
    return read("orders").join(first_shipment, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("shipped").alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(ESTIMATE_DAYS))).alias("order_estimated_delivery_date"),
    )


VIEWS: dict[str, Callable[[Read], DataFrame]] = {
    "product_category_name_translation": _translation,
    "customers": _customers,
    "sellers": _sellers,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
    "order_payments": _order_payments,
    "order_reviews": _order_reviews,
}
