"""The nine tables: columns, keys and rules, as plain data.

Names, types, lengths and rules are fixed values: extracts are read by column position, and a
load is accepted or refused by exactly these rules. "lenght" is how the extracts spell it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

TEXT = StringType()
SHORT = ShortType()
INT = IntegerType()
MONEY = DecimalType(10, 2)
DEGREES = DecimalType(18, 14)
TIME = TimestampNTZType()


@dataclass(frozen=True)
class Column:
    name: str
    type: DataType
    required: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class Table:
    """One table; ``references`` maps a column to the table whose key has the same name.

    ``keep_first`` names the order in which one of several rows with an equal key is kept; an
    empty tuple means equal keys are an error. ``cluster_by`` is the column a load may bucket the
    table by: only columns whose every value holds few rows, so that no bucket can be hot.
    """

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    keep_first: tuple[str, ...] = ()
    cluster_by: str | None = None

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.type, True) for c in self.columns])

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length}


def _id(name: str) -> Column:
    return Column(name, TEXT, required=True, max_length=32)


def _text(name: str, length: int, required: bool = True) -> Column:
    return Column(name, TEXT, required=required, max_length=length)


# Parents come before the tables that refer to them.
TABLES: tuple[Table, ...] = (
    Table(
        "product_category_name_translation",
        (
            _text("product_category_name", 100),
            _text("product_category_name_english", 100),
        ),
        key=("product_category_name",),
    ),
    Table(
        "geolocation",
        (
            _text("geolocation_zip_code_prefix", 5),
            Column("geolocation_lat", DEGREES, required=True),
            Column("geolocation_lng", DEGREES, required=True),
            _text("geolocation_city", 100),
            _text("geolocation_state", 2),
        ),
    ),
    Table(
        "customers",
        (
            _id("customer_id"),
            _id("customer_unique_id"),
            _text("customer_zip_code_prefix", 5),
            _text("customer_city", 100),
            _text("customer_state", 2),
        ),
        key=("customer_id",),
        cluster_by="customer_id",
    ),
    Table(
        "sellers",
        (
            _id("seller_id"),
            _text("seller_zip_code_prefix", 5),
            _text("seller_city", 100),
            _text("seller_state", 2),
        ),
        key=("seller_id",),
    ),
    Table(
        "products",
        (
            _id("product_id"),
            _text("product_category_name", 100, required=False),
            Column("product_name_lenght", SHORT),
            Column("product_description_lenght", INT),
            Column("product_photos_qty", SHORT),
            Column("product_weight_g", INT),
            Column("product_length_cm", SHORT),
            Column("product_height_cm", SHORT),
            Column("product_width_cm", SHORT),
        ),
        key=("product_id",),
    ),
    Table(
        "orders",
        (
            _id("order_id"),
            _id("customer_id"),
            _text("order_status", 20),
            Column("order_purchase_timestamp", TIME),
            Column("order_approved_at", TIME),
            Column("order_delivered_carrier_date", TIME),
            Column("order_delivered_customer_date", TIME),
            Column("order_estimated_delivery_date", TIME),
        ),
        key=("order_id",),
        references={"customer_id": "customers"},
        cluster_by="order_id",
    ),
    Table(
        "order_items",
        (
            _id("order_id"),
            Column("order_item_id", SHORT, required=True),
            _id("product_id"),
            _id("seller_id"),
            Column("shipping_limit_date", TIME),
            Column("price", MONEY, required=True),
            Column("freight_value", MONEY, required=True),
        ),
        key=("order_id", "order_item_id"),
        references={"order_id": "orders", "product_id": "products", "seller_id": "sellers"},
        # The item number is a small integer and part of the key: an order has few items.
        cluster_by="order_id",
    ),
    Table(
        "order_payments",
        (
            _id("order_id"),
            Column("payment_sequential", SHORT, required=True),
            _text("payment_type", 30),
            Column("payment_installments", SHORT, required=True),
            Column("payment_value", MONEY, required=True),
        ),
        key=("order_id", "payment_sequential"),
        references={"order_id": "orders"},
    ),
    Table(
        "order_reviews",
        (
            _id("review_id"),
            _id("order_id"),
            Column("review_score", SHORT, required=True),
            Column("review_comment_title", TEXT),
            Column("review_comment_message", TEXT),
            Column("review_creation_date", TIME),
            Column("review_answer_timestamp", TIME),
        ),
        key=("review_id",),
        references={"order_id": "orders"},
        ranges={"review_score": (1, 5)},
        # Raw files repeat review ids; the earliest review stays, the remaining columns only
        # make the choice the same on every run.
        keep_first=(
            "review_creation_date",
            "review_answer_timestamp",
            "order_id",
            "review_score",
            "review_comment_title",
            "review_comment_message",
        ),
    ),
)

BY_NAME: dict[str, Table] = {t.name: t for t in TABLES}
