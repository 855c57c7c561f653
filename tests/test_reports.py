"""Reports on hand-made orders, one odd case each."""

from datetime import datetime
from decimal import Decimal

import pytest

from bazaarlens import plans
from bazaarlens.schemas import BY_NAME


def when(text):
    return datetime.fromisoformat(text) if text else None


class Shop:
    """Collects rows and hands them out as tables; every order has its own customer row."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in BY_NAME}

    def order(self, order_id, person="u1", state="SP", status="delivered", bought="2017-01-10", delivered=None,
              estimated=None):
        self.rows["customers"].append((f"c-{order_id}", person, "01037", "city", state))
        self.rows["orders"].append(
            (order_id, f"c-{order_id}", status, when(bought), None, None, when(delivered), when(estimated))
        )
        return self

    def item(self, order_id, price, freight="0.00", product="p1", seller="s1"):
        number = sum(r[0] == order_id for r in self.rows["order_items"]) + 1
        self.rows["order_items"].append((order_id, number, product, seller, None, Decimal(price), Decimal(freight)))
        return self

    def review(self, order_id, score):
        number = len(self.rows["order_reviews"]) + 1
        self.rows["order_reviews"].append((f"r{number}", order_id, score, None, None, None, None))
        return self

    def payment(self, order_id, kind, value, installments=1):
        number = sum(r[0] == order_id for r in self.rows["order_payments"]) + 1
        self.rows["order_payments"].append((order_id, number, kind, installments, Decimal(value)))
        return self

    def product(self, product, category):
        self.rows["products"].append((product, category, *[None] * 7))
        return self

    def seller(self, seller, state="SP"):
        self.rows["sellers"].append((seller, "01037", "city", state))
        return self

    def translation(self, name, english):
        self.rows["product_category_name_translation"].append((name, english))
        return self

    def run(self, report):
        tables = {n: self.spark.createDataFrame(r, BY_NAME[n].schema) for n, r in self.rows.items()}
        return [r.asDict() for r in report(tables).collect()]


@pytest.fixture
def shop(spark):
    return Shop(spark).seller("s1").product("p1", "toys")


def d(text):
    return Decimal(text)


def test_months_in_order_with_gaps_zero_and_null(shop):
    shop.order("a", bought="2017-03-01").item("a", "10.00", "2.00")
    shop.order("b", bought="2017-01-31").item("b", "8.00")
    shop.order("z", bought="2017-04-02").item("z", "0.00")
    shop.order("e", bought="2017-05-02").item("e", "5.00")
    shop.order("n", bought=None).item("n", "1.00")
    shop.order("x", status="canceled", bought="2017-02-01").item("x", "99.00")
    shop.order("y", status="unavailable", bought="2017-02-01").item("y", "99.00")
    shop.order("w", bought="2017-02-01")  # no items, no month
    got = [tuple(r.values()) for r in shop.run(plans.monthly_revenue)]
    assert got == [
        ("2017-01", d("8.00"), None, None),
        ("2017-03", d("12.00"), d("8.00"), d("50.00")),
        ("2017-04", d("0.00"), d("12.00"), d("-100.00")),
        ("2017-05", d("5.00"), d("0.00"), None),
        (None, d("1.00"), d("5.00"), d("-80.00")),
    ]


def test_category_names(shop):
    shop.translation("toys", "games").product("p2", "raw").product("p3", None).product("p4", "games")
    shop.order("a").item("a", "5.00").item("a", "3.01", product="p2").item("a", "1.00", product="p3")
    shop.order("b").item("b", "2.00").item("b", "2.00", product="p4")
    got = [tuple(r.values()) for r in shop.run(plans.top_categories)]
    assert got == [
        ("games", 2, d("9.00"), d("3.00")),
        ("raw", 1, d("3.01"), d("3.01")),
        ("Uncategorized", 1, d("1.00"), d("1.00")),
    ]


def test_delivery_times(shop):
    shop.order("a", bought="2017-01-01 00:00", delivered="2017-01-02 12:00", estimated="2017-01-02 00:00")
    shop.order("b", bought="2017-01-01", delivered="2017-01-02", estimated=None)
    shop.order("c", bought="2017-01-01", delivered=None, estimated="2017-01-02")
    shop.order("s", status="shipped", bought="2017-01-01", delivered="2017-03-02", estimated="2017-01-02")
    shop.order("r", state="RJ", bought="2017-01-01", delivered="2017-01-01 06:00", estimated="2017-01-11 06:00")
    got = [tuple(r.values()) for r in shop.run(plans.delivery_by_state)]
    assert got == [("RJ", 1, d("0.3"), d("10.0")), ("SP", 2, d("1.3"), d("-0.5"))]
    assert [tuple(r.values()) for r in shop.run(plans.overall_delivery)] == [(3, d("0.9"), d("4.8"))]


def test_order_paid_in_two_ways_counts_twice(shop):
    shop.payment("a", "credit_card", "10.00", 3).payment("a", "voucher", "5.00").payment("a", "voucher", "0.01")
    shop.payment("b", "credit_card", "1.00", 2)
    got = [tuple(r.values()) for r in shop.run(plans.payment_breakdown)]
    assert got == [
        ("credit_card", 2, d("11.00"), d("5.50"), d("2.5"), d("66.67")),
        ("voucher", 1, d("5.01"), d("2.51"), d("1.0"), d("33.33")),
    ]


def test_reviews_repeat_seller_revenue(shop):
    shop.seller("s2", "RJ").seller("s3")
    shop.order("a").item("a", "10.00").item("a", "1.00", product="p2").review("a", 5).review("a", 2)
    shop.order("b").item("b", "7.00", seller="s2")
    shop.order("c", status="canceled").item("c", "100.00").review("c", 1)
    got = [tuple(r.values()) for r in shop.run(plans.top_sellers)]
    assert got == [
        ("s1", "city", "SP", 1, 2, d("22.00"), d("3.50")),
        ("s2", "city", "RJ", 1, 1, d("7.00"), None),
    ]
    true = {r["seller_id"]: (r["revenue"], r["reported_revenue"]) for r in shop.run(plans.seller_revenue_true)}
    assert true == {"s1": (d("11.00"), d("22.00")), "s2": (d("7.00"), d("7.00"))}
    where = [tuple(r.values()) for r in shop.run(plans.seller_state_concentration)]
    assert where == [("RJ", 1, d("7.00")), ("SP", 1, d("22.00"))]


def test_categories_need_thirty_review_rows(shop):
    shop.product("p2", "books")
    for n in range(15):
        shop.order(f"t{n}", status="canceled").item(f"t{n}", "1.00").item(f"t{n}", "1.00").review(f"t{n}", 1 + n % 5)
    for n in range(29):
        shop.order(f"b{n}").item(f"b{n}", "1.00", product="p2").review(f"b{n}", 5)
    got = [tuple(r.values()) for r in shop.run(plans.review_by_category)]
    assert got == [("toys", 30, d("3.00"), 6, 12)]


def test_states_count_items_orders_and_persons(shop):
    shop.order("a").item("a", "1.00", "0.50").item("a", "2.00")
    shop.order("b").item("b", "4.00")
    shop.order("c", person="u2", state="RJ").item("c", "9.00")
    shop.order("e", person="u3")  # no items
    got = [tuple(r.values()) for r in shop.run(plans.state_volume)]
    assert got == [("SP", 2, 1, d("7.50"), d("2.50")), ("RJ", 1, 1, d("9.00"), d("9.00"))]
    per_order = {r["customer_state"]: r["avg_order_value"] for r in shop.run(plans.order_value_true)}
    assert per_order == {"SP": d("3.75"), "RJ": d("9.00")}
    shares = {r["customer_state"]: r["pct_of_orders"] for r in shop.run(plans.state_share)}
    assert shares == {"SP": d("66.67"), "RJ": d("33.33")}


def test_segments_and_lifetime_leave_out_canceled_orders(shop):
    for person, orders in {"one": 1, "two": 2, "three": 3, "five": 5, "six": 6}.items():
        for n in range(orders):
            shop.order(f"{person}{n}", person=person, bought=f"2017-01-{n + 1:02}").item(f"{person}{n}", "10.00")
    shop.order("gone", person="gone", status="canceled").item("gone", "10.00")
    got = [tuple(r.values()) for r in shop.run(plans.repeat_customers)]
    assert got == [
        ("1 – One-time buyer", 1, d("20.00")),
        ("2 – Repeat (2 orders)", 1, d("20.00")),
        ("3-5 – Loyal", 2, d("40.00")),
        ("6+ – VIP", 1, d("20.00")),
    ]
    top = shop.run(plans.customer_lifetime_value)
    assert [(r["customer_unique_id"], r["lifetime_value"], r["clv_quartile"], r["customer_lifespan_days"]) for r in top] == [
        ("six", d("60.00"), 1, 5),
        ("five", d("50.00"), 1, 4),
        ("three", d("30.00"), 2, 2),
        ("two", d("20.00"), 3, 1),
        ("one", d("10.00"), 4, 0),
    ]
    full = {r["customer_unique_id"]: r["clv_quartile"] for r in shop.run(plans.customer_lifetime_value_full)}
    assert full == {r["customer_unique_id"]: r["clv_quartile"] for r in top}
    quartiles = shop.run(plans.clv_quartiles)
    assert [(r["customers"], r["avg_lifetime_value"], r["avg_lifetime_value_all"]) for r in quartiles] == [
        (2, d("55.00"), d("34.00")), (1, d("30.00"), d("34.00")), (1, d("20.00"), d("34.00")), (1, d("10.00"), d("34.00")),
    ]


def test_statuses(shop):
    shop.order("a").order("b").order("c", status="canceled")
    got = [tuple(r.values()) for r in shop.run(plans.status_breakdown)]
    assert got == [("delivered", 2, d("66.67")), ("canceled", 1, d("33.33"))]


def test_category_shares_run_to_the_whole(shop):
    shop.product("p2", "books").product("p3", "music")
    shop.order("a").item("a", "50.00").item("a", "30.00", product="p2").item("a", "20.00", product="p3")
    got = [tuple(r.values()) for r in shop.run(plans.category_share)]
    assert got == [
        ("toys", d("50.00"), d("50.00"), d("50.00")),
        ("books", d("30.00"), d("30.00"), d("80.00")),
        ("music", d("20.00"), d("20.00"), d("100.00")),
    ]
