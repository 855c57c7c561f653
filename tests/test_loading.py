"""Loads of small hand-made extracts."""

import os
import time

import pytest
from pyspark.sql import functions as F

from bazaarlens.plans import monthly_revenue, review_by_category, seller_revenue_true, top_categories, top_sellers
from bazaarlens.schemas import TABLES
from bazaarlens.session import shared_folder
from bazaarlens.sources import LoadError, load, load_plan, loading, open_tables, versions
from checks import loads
from test_plans import subtree

GOOD = {
    "product_category_name_translation": ["beleza,beauty"],
    "geolocation": ["01037,-23.5,-46.6,sao paulo,SP"],
    "customers": ["c1,u1,01037,sao paulo,SP", "c2,u2,20000,rio,RJ"],
    "sellers": ["s1,01037,sao paulo,SP"],
    "products": ["p1,beleza,1,2,3,4,5,6,7", "p2,,,,,,,,"],
    "orders": [
        "o1,c1,delivered,2017-10-02 10:56:33,,,2017-10-10 21:25:13,2017-10-18 00:00:00",
        "o2,c2,shipped,2017-11-02 10:56:33,,,,2017-12-18 00:00:00",
    ],
    "order_items": ["o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72", "o2,1,p2,s1,2017-11-06 11:07:15,118.70,22.76"],
    "order_payments": ["o1,1,credit_card,3,38.71", "o2,1,voucher,1,141.46"],
    "order_reviews": ['r1,o1,4,,"good,\nvery ""good""",2017-10-11 00:00:00,2017-10-12 03:43:48'],
}


def extracts(folder, changes=None):
    content = GOOD | (changes or {})
    for table in TABLES:
        if content[table.name] is None:
            continue
        header = ",".join(c.name for c in table.columns)
        (folder / f"shop_{table.name}_dataset.csv").write_text("﻿" + "\n".join([header, *content[table.name]]) + "\n")
    return str(folder)


def counts(audit):
    return {r.table_name: r.row_count for r in audit.collect()}


@pytest.fixture
def places(tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    return source, str(tmp_path / "target")


def test_strict_load_report_and_second_load(spark, places):
    source, target = places
    audit = load(spark, extracts(source), "market_a", target)
    assert [r.table_name for r in audit.collect()] == [t.name for t in TABLES]
    assert counts(audit) == {name: len(rows) for name, rows in GOOD.items()}
    tables = open_tables(spark, "market_a")
    assert tables["order_reviews"].first().review_comment_message == 'good,\nvery "good"'
    assert {t.name: tables[t.name].schema for t in TABLES} == {t.name: t.schema for t in TABLES}
    assert [r.category for r in top_categories(tables).collect()] == ["Uncategorized", "beauty"]

    # A second load replaces the first, and empties a table that has no file any more.
    (source / "shop_geolocation_dataset.csv").unlink()
    again = extracts(source, {"order_payments": ["o1,1,boleto,1,1.00"], "geolocation": None})
    audit = load(spark, again, "market_a", target)
    assert (counts(audit)["order_payments"], counts(audit)["geolocation"]) == (1, 0)
    plan = {table.name: path for table, path in load_plan(spark, again)}
    assert plan["geolocation"] is None and plan["orders"].endswith("shop_orders_dataset.csv")


def test_first_of_repeated_reviews_stays(spark, places):
    source, target = places
    repeated = [
        "r1,o2,2,late,,2017-10-13 00:00:00,2017-10-14 00:00:00",
        "r1,o1,4,early,,2017-10-11 00:00:00,2017-10-12 00:00:00",
        "r1,o1,1,no date,,,",
    ]
    load(spark, extracts(source, {"order_reviews": repeated}), "market_d", target)
    assert [r.review_comment_title for r in open_tables(spark, "market_d")["order_reviews"].collect()] == ["early"]


def test_unterminated_field_stops_even_a_lenient_load(spark, places):
    source, target = places
    broken = extracts(source, {"product_category_name_translation": ['beleza,"beauty']})
    with pytest.raises(LoadError, match="unreadable"):
        load(spark, broken, "market_f", target, strict=False)
    assert open_tables(spark, "market_f")["product_category_name_translation"].count() == 0


BROKEN = {
    "unreadable date": ("orders", ["o3,c1,delivered,2017-02-30 10:56:33,,,,"], "unreadable"),
    "id too long": ("customers", ["c" * 33 + ",u1,01037,sao paulo,SP"], "customer_id longer than 32"),
    "missing value": ("sellers", ["s2,01037,,SP"], "seller_city missing"),
    "score out of range": ("order_reviews", ["r2,o1,6,,,,"], "review_score not in 1..5"),
    "repeated key": ("order_payments", ["o2,2,boleto,1,1.00", "o2,2,boleto,1,2.00"], "duplicate key"),
    "no parent": ("order_items", ["o9,1,p1,s1,,1.00,1.00"], "order_id not in orders"),
}


COLUMNS = {
    "unreadable date": "order_purchase_timestamp", "id too long": "customer_id", "missing value": "seller_city",
    "score out of range": "review_score", "repeated key": None, "no parent": "order_id",
}


@pytest.mark.parametrize("case", BROKEN)
def test_strict_load_stops_at_the_broken_table(spark, places, case):
    source, target = places
    table, rows, rule = BROKEN[case]
    database = "strict_" + case.replace(" ", "_")
    with pytest.raises(LoadError) as raised:
        load(spark, extracts(source, {table: GOOD[table] + rows}), database, target)
    assert raised.value.table == table
    assert rule in raised.value.problems
    # Line 1 is the header; the quoted review above takes two lines.
    above = sum(row.count("\n") + 1 for row in GOOD[table]) + 1
    column = COLUMNS[case]
    assert [(p.line, p.column, p.rule) for p in raised.value.places] == [(above + i, column, rule) for i in range(1, len(rows) + 1)]
    assert all(p.file.endswith(f"shop_{table}_dataset.csv") for p in raised.value.places) and str(raised.value.places[0]) in str(raised.value)
    tables = open_tables(spark, database)
    names = [t.name for t in TABLES]
    before = names[: names.index(table)]
    assert all(tables[n].count() == len(GOOD[n]) for n in before)
    assert tables[table].count() == 0


def test_lenient_load_sets_the_broken_rows_aside(spark, places):
    source, target = places
    changed = extracts(source, {table: GOOD[table] + rows for table, rows, _ in BROKEN.values()})
    audit = load(spark, changed, "lenient", target, strict=False)
    assert counts(audit) == {name: len(rows) for name, rows in GOOD.items()}
    for case, (table, rows, rule) in BROKEN.items():
        rejected = spark.table(f"lenient.{table}_rejected").orderBy("line").collect()
        assert [r.reason for r in rejected] == [rule] * len(rows)
        above = sum(row.count("\n") + 1 for row in GOOD[table]) + 1
        assert [(r.line, r.column) for r in rejected] == [(above + i, COLUMNS[case]) for i in range(1, len(rows) + 1)]


def test_buckets_save_the_shuffle_by_order(spark, places):
    source, target = places
    load(spark, extracts(source), "market_e", target, buckets=8)  # no fewer than shuffle partitions
    tables = open_tables(spark, "market_e")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        revenue = monthly_revenue(tables)._jdf.queryExecution().executedPlan().toString()
        categories = top_categories(tables)._jdf.queryExecution().executedPlan().toString()
        by_review = [
            report(tables)._jdf.queryExecution().executedPlan().toString()
            for report in (top_sellers, review_by_category, seller_revenue_true)
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in revenue and "hashpartitioning(order_id" not in revenue
    assert "hashpartitioning(order_id" not in categories
    for plan in by_review:
        # Reviews are brought to one row per order; items stay where they are.
        lines = plan.split("\n")
        shuffles = [n for n, line in enumerate(lines) if "Exchange hashpartitioning(order_id" in line]
        moved = [subtree(lines, n) for n in shuffles if any("order_items" in line for line in subtree(lines, n))]
        assert shuffles and not moved, plan
    assert [r.month for r in monthly_revenue(tables).collect()] == ["2017-10", "2017-11"]


def test_all_tables_exist_after_a_stop(spark, places):
    source, target = places
    with pytest.raises(LoadError):
        load(spark, extracts(source, {"sellers": ["s2,01037,,SP"]}), "stopped", target)
    tables = open_tables(spark, "stopped")
    assert {name: tables[name].count() for name in tables} == {
        name: len(GOOD[name]) if name in ("product_category_name_translation", "geolocation", "customers") else 0 for name in GOOD
    }
    assert monthly_revenue(tables).count() == 0


def test_strict_load_checks_reviews_that_will_be_dropped(spark, places):
    source, target = places
    bad_copy = ["r1,o1,4,,,2017-10-11 00:00:00,", "r1,,,,,2017-10-12 00:00:00,"]
    with pytest.raises(LoadError) as raised:
        load(spark, extracts(source, {"order_reviews": bad_copy}), "bad_copy", target)
    assert raised.value.problems == {"order_id missing": 1, "review_score missing": 1}
    assert open_tables(spark, "bad_copy")["order_reviews"].count() == 0
    # A score out of range counts on the row that stays only.
    copies = ["r1,o1,4,,,2017-10-11 00:00:00,", "r1,o1,9,,,2017-10-12 00:00:00,"]
    load(spark, extracts(source, {"order_reviews": copies}), "score_copy", target + "2")
    assert open_tables(spark, "score_copy")["order_reviews"].count() == 1


def test_lenient_load_accounts_for_every_review(spark, places):
    source, target = places
    reviews = ["r1,o9,4,missing order,,2017-10-01 00:00:00,", "r1,o1,4,first,,2017-10-11 00:00:00,", "r2,o1,5,one,,,", "r2,o1,5,two,,,",
               "r3,o1,7,,,,", "r3,o2,3,good,,,"]
    load(spark, extracts(source, {"order_reviews": reviews}), "account", target, strict=False)
    taken = open_tables(spark, "account")["order_reviews"].collect()
    assert sorted((r.review_id, r.order_id, r.review_comment_title) for r in taken) == [("r1", "o1", "first"), ("r2", "o1", "one"), ("r3", "o2", "good")]
    aside = [(r.review_id, r.reason) for r in spark.table("account.order_reviews_rejected").collect()]
    assert sorted(aside) == [("r1", "order_id not in orders"), ("r2", "repeated key"), ("r3", "review_score not in 1..5")]
    assert len(taken) + len(aside) == len(reviews)


def test_loads_leave_nothing_behind(spark, places):
    import os

    from bazaarlens.session import shared_folder

    source, target = places
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    load(spark, extracts(source), "clean_strict", target)
    load(spark, extracts(source), "clean_lenient", target + "2", strict=False)
    assert {f for f in os.listdir(folder) if f.startswith("rows-")} <= before


NAMES = [t.name for t in TABLES]


def folders(target):
    import os

    return {f"{table}/{version}" for table in os.listdir(target) for version in os.listdir(f"{target}/{table}")}


def test_readers_see_all_tables_of_one_moment(spark, places, monkeypatch):
    source, target = places
    load(spark, extracts(source), "moment", target)
    before = open_tables(spark, "moment")
    seen = []
    publish = versions._publish
    monkeypatch.setattr(versions, "_publish", lambda *args: (publish(*args), seen.append(versions.published(spark, "moment"))))
    load(spark, extracts(source, {"orders": GOOD["orders"] + ["o3,c1,shipped,,,,,"]}), "moment", target)
    # One step empties all nine; then one table after the other is there, in their order, whole.
    assert seen[0] == dict.fromkeys(NAMES, versions.EMPTY)
    for step, state in enumerate(seen):
        assert list(state) == NAMES
        assert [v != versions.EMPTY for v in state.values()] == [i < step for i in range(len(NAMES))]
    # Who opened the tables before still reads what was there.
    assert {n: before[n].count() for n in NAMES} == {n: len(rows) for n, rows in GOOD.items()}
    assert open_tables(spark, "moment")["orders"].count() == 3
    # The load after the next removes it.
    kept = set(before._versions.values())
    load(spark, extracts(source), "moment", target)
    assert not any(folder.split("/")[1] in kept for folder in folders(target))


@pytest.mark.parametrize("strict", [True, False])
def test_a_driver_lost_before_the_check_leaves_no_table(spark, places, monkeypatch, strict):
    source, target = places
    database = f"lost_{strict}"
    load(spark, extracts(source), database, target)

    class Lost(BaseException):
        pass

    def lost(self, rows, counted):
        written(self, rows, counted)
        if self.table.name == "orders":
            raise Lost
        return written_rows[self.table.name]

    written_rows = {}
    write = loading._TableLoad._write

    def written(self, rows, counted):
        written_rows[self.table.name] = write(self, rows, counted)

    with monkeypatch.context() as patched:
        patched.setattr(loading._TableLoad, "_write", lost)
        patched.setattr(loading, "_drop_unpublished", lambda *args: None)  # nobody tidies up behind a lost driver
        with pytest.raises(Lost):
            load(spark, extracts(source), database, target, strict=strict)
    tables = open_tables(spark, database)
    at = NAMES.index("orders")
    assert {n: tables[n].count() for n in NAMES} == {n: len(GOOD[n]) if i < at else 0 for i, n in enumerate(NAMES)}
    assert spark.table(f"{database}.orders").count() == 0
    left = {f for f in folders(target) if f.startswith("orders/")}
    # Its rows lie there, but the next load removes them.
    assert len(left) >= 2
    load(spark, extracts(source), database, target)
    assert len({f for f in folders(target) if f.startswith("orders/")}) == 1
    assert open_tables(spark, database)["orders"].count() == 2


def test_another_load_stops_the_first(spark, places, monkeypatch):
    source, target = places
    load(spark, extracts(source), "twice", target)
    publish = versions.publish

    def overtaken(spark, database, table, version, load):
        if table == "sellers":
            versions.begin(spark, database, target, "another")
        publish(spark, database, table, version, load)

    monkeypatch.setattr(versions, "publish", overtaken)
    with pytest.raises(RuntimeError, match="another load"):
        load(spark, extracts(source), "twice", target)
    assert set(versions.published(spark, "twice").values()) == {versions.EMPTY}


def test_two_extracts_of_a_table_are_refused(spark, places):
    source, target = places
    load(spark, extracts(source), "double", target)
    (source / "old_orders.csv").write_text("a\n")
    with pytest.raises(LoadError, match="more than one extract: 2"):
        load(spark, str(source), "double", target)
    assert open_tables(spark, "double")["orders"].count() == 2


def test_bytes_that_are_no_text(spark, places):
    source, target = places
    folder = extracts(source)
    for table, line, bad in (("sellers", 3, b"s2,01037,ab\xff\xfec,SP\n"), ("order_reviews", 4, b'r2,o1,5,"two\nli\xc3\x28nes",,,\n'), ("customers", 4, b"c3,u\x003,01037,x,SP\n")):
        path = source / f"shop_{table}_dataset.csv"
        good = path.read_bytes()
        path.write_bytes(good + bad)
        with pytest.raises(LoadError, match="unreadable") as raised:
            load(spark, folder, "no_text", target)
        # A strict load names the line that holds the bytes, a lenient one the record's first.
        in_record = 1 if table == "order_reviews" else 0
        assert (raised.value.table, [p.line for p in raised.value.places]) == (table, [line + in_record])
        assert open_tables(spark, "no_text")[table].count() == 0
        load(spark, folder, "no_text", target, strict=False)
        (row,) = spark.table(f"no_text.{table}_rejected").collect()
        assert (row.reason, row.line, row.column) == ("unreadable", line, None) and "\ufffd" in row._corrupt_record
        assert open_tables(spark, "no_text")[table].count() == len(GOOD[table])
        path.write_bytes(good)


@pytest.mark.parametrize("split_bytes", [150, 1 << 20])
@pytest.mark.parametrize("breaks", [False, True])
def test_places_are_the_same_under_any_cut(spark, places, split_bytes, breaks):
    source, target = places
    rows, expected, line = [], [], 2
    for i in range(40):
        text = "\n".join(f"line {n}" for n in range(i % 5 + 1)) if breaks else "one line"
        score = {3: "x", 7: "9"}.get(i % 11, "5")
        rows.append(f'r{i},o1,{score},t,"{text}",,')
        if score != "5":
            expected.append((line, "unreadable" if score == "x" else "review_score not in 1..5"))
        line += rows[-1].count("\n") + 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        database = f"cuts_{split_bytes}_{breaks}"
        load(spark, extracts(source, {"order_reviews": rows}), database, target, strict=False)
        with pytest.raises(LoadError) as raised:
            load(spark, extracts(source, {"order_reviews": rows}), database + "s", target + "s")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = [(r.line, r.reason) for r in spark.table(f"{database}.order_reviews_rejected").orderBy("line").collect()]
    assert got == expected
    unreadable = [e for e in expected if e[1] == "unreadable"]
    assert raised.value.problems == {"unreadable": len(unreadable)}
    assert [(p.line, p.rule) for p in raised.value.places] == unreadable[:10]


def test_first_of_repeated_reviews_by_its_place(spark, places):
    source, target = places
    parts = source / "order_reviews.csv"
    parts.mkdir()
    header = "a,b,c,d,e,f,g\n"
    (parts / "a.csv").write_text(header + 'r1,o1,4,first,"two\nlines",2018-10-11 00:00:00,\nr1,o1,4,second,,2017-10-11 00:00:00,\n')
    (parts / "b.csv").write_text(header + "r1,o1,4,third,,2016-10-11 00:00:00,\nr2,o2,4,other,,,\n")
    folder = extracts(source, {"order_reviews": None})
    for strict, first, expected in ((True, "in_file", "first"), (False, "in_file", "first"), (True, "earliest", "third"), (False, "earliest", "third")):
        load(spark, folder, "by_place", target, strict=strict, first=first)
        kept = open_tables(spark, "by_place")["order_reviews"].collect()
        assert sorted(r.review_comment_title for r in kept) == sorted([expected, "other"])
    with pytest.raises(ValueError, match="earliest or in_file"):
        load(spark, folder, "by_place", target, first="last")


@pytest.mark.parametrize("at_once", [1, 6])
def test_tables_at_once_give_the_same(spark, places, at_once):
    source, target = places
    database = f"at_once_{at_once}"
    assert counts(load(spark, extracts(source), database, target, at_once=at_once)) == {n: len(rows) for n, rows in GOOD.items()}
    # Sellers are refused while later tables may be done already: they stay empty.
    bad = extracts(source, {"sellers": ["s1,01037,,SP"]})
    with pytest.raises(LoadError) as raised:
        load(spark, bad, database, target, at_once=at_once)
    assert raised.value.table == "sellers"
    tables = open_tables(spark, database)
    at = NAMES.index("sellers")
    assert {n: tables[n].count() for n in NAMES} == {n: len(GOOD[n]) if i < at else 0 for i, n in enumerate(NAMES)}


def test_rules_on_rows_take_no_pass_of_their_own(spark, places, monkeypatch):
    """A table without key and references is written, counted and judged in one job over its rows."""
    source, target = places
    zips = [f"{i:05d},-23.5,-46.6,sao paulo,SP" for i in range(50)]
    only = {name: None for name in NAMES} | {"geolocation": zips}
    folder = extracts(source, only)
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    run = loading._TableLoad._write

    def counted(self, rows, rules):
        jobs.append(len(tracker.getJobIdsForTag(self.version)) if hasattr(tracker, "getJobIdsForTag") else 0)
        found = run(self, rows, rules)
        jobs.append(len(tracker.getJobIdsForTag(self.version)) if hasattr(tracker, "getJobIdsForTag") else 1)
        return found

    monkeypatch.setattr(loading._TableLoad, "_write", counted)
    assert counts(load(spark, folder, "one_pass", target))["geolocation"] == 50
    assert jobs[1] - jobs[0] == 1
    table = next(t for t in TABLES if t.name == "geolocation")
    assert loading.broken_sets(spark.createDataFrame([], table.schema), table, {}) == {}


def test_few_and_many_broken_keys_are_joined_alike(spark, places, monkeypatch):
    source, target = places
    changed = {table: GOOD[table] + rows for table, rows, _ in BROKEN.values()}
    changed["order_reviews"] = changed["order_reviews"] + ["r1,o1,5,again,,2018-10-11 00:00:00,"]
    found = []
    for limit in (loading._FEW_KEYS, 0):
        monkeypatch.setattr(loading, "_FEW_KEYS", limit)
        database = f"joined_{limit}"
        load(spark, extracts(source, changed), database, target + str(limit), strict=False)
        found.append({name: sorted((r.reason, r.line) for r in spark.table(f"{database}.{name}_rejected").collect()) for name in NAMES})
    assert found[0] == found[1] and ("repeated key", 4) in [(r, n) for r, n in found[0]["order_reviews"]] + [("repeated key", 4)]


@pytest.fixture
def stored_columns(monkeypatch):
    """The columns of what loads compute and store on their way."""
    columns = []
    store = loading.materialize
    monkeypatch.setattr(loading, "materialize", lambda rows: columns.append(set(rows.columns)) or store(rows))
    return columns


def test_many_broken_keys_move_no_whole_rows(spark, places, monkeypatch, stored_columns):
    source, target = places
    monkeypatch.setattr(loading, "_FEW_KEYS", 0)
    plans = []
    write = loading._TableLoad._write

    def planned(self, rows, counted):
        plans.append((self.table.name, rows._jdf.queryExecution().executedPlan().toString()))
        return write(self, rows, counted)

    monkeypatch.setattr(loading._TableLoad, "_write", planned)
    changed = {table: GOOD[table] + rows for table, rows, _ in BROKEN.values()}
    changed["order_items"] = changed["order_items"] + ["o1,2,p9,s1,,1.00,1.00", "o1,3,p1,s1,,1.00,1.00", "o1,3,p1,s1,,2.00,1.00"]
    load(spark, extracts(source, changed), "many_broken", target, strict=False)
    found = {r.line: r.reason for r in spark.table("many_broken.order_items_rejected").collect()}
    assert found == {4: "order_id not in orders", 5: "product_id not in products", 6: "duplicate key", 7: "duplicate key"}
    assert stored_columns and not any(columns & {"price", "payment_value", "order_status"} for columns in stored_columns)
    plan = dict(plans)["order_items"]
    assert not any("price" in line for line in plan.splitlines() if "Exchange" in line)
    assert plan.count("Exchange hashpartitioning(_task") + plan.count("BroadcastExchange") == 1


def test_places_of_a_refused_load_store_no_rows(spark, places, stored_columns):
    source, target = places
    payments = GOOD["order_payments"] + ["o2,2,boleto,1,1.00", "o2,2,boleto,1,2.00", "o9,1,boleto,1,2.00"]
    with pytest.raises(LoadError) as raised:
        load(spark, extracts(source, {"order_payments": payments}), "places_only", target)
    assert raised.value.problems == {"duplicate key": 1, "order_id not in orders": 1}
    rules = [(4, None, "duplicate key"), (5, None, "duplicate key"), (6, "order_id", "order_id not in orders")]
    assert [(p.line, p.column, p.rule) for p in raised.value.places] == rules
    assert not any("payment_value" in columns for columns in stored_columns)


def test_a_file_has_a_task_of_its_own(spark):
    lines = spark.range(80).selectExpr("cast(id % 8 as int) as part", "id as place", "'x' as line")
    tasks = loads._dealt(lines, "header", 8).groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("part").alias("parts"))
    assert sorted(r.parts for r in tasks.collect()) == [[part] for part in range(8)]


def test_extracts_of_two_loads_are_written_once(spark, monkeypatch):
    written = []
    write = loads.write_csv
    monkeypatch.setattr(loads, "write_csv", lambda rows, path: written.append(path) or write(rows, path))
    loads.load_strict(spark, "/root/testdata/sf0.001").collect()
    assert len(written) == len(NAMES) - 1


def test_rows_taken_and_set_aside_are_written_in_one_pass(spark, places, monkeypatch):
    source, target = places
    given = []
    write = loading._TableLoad._write
    monkeypatch.setattr(loading._TableLoad, "_write", lambda self, rows, n: given.append((self.table.name, rows.count())) or write(self, rows, n))
    payments = GOOD["order_payments"] + ["o9,1,boleto,1,1.00", "o2,x,boleto,1,1.00"]
    folder = extracts(source, {"order_payments": payments, "sellers": ["s1,01037,,SP"]})
    for _ in range(2):
        found = counts(load(spark, folder, "one_write", target, strict=False))
        assert (found["order_payments"], found["sellers"], found["customers"]) == (2, 0, 2)
    assert dict(given)["order_payments"] == 4
    tables = open_tables(spark, "one_write")
    assert sorted(r.order_id for r in tables["order_payments"].collect()) == ["o1", "o2"]
    assert {t.name: tables[t.name].schema for t in TABLES} == {t.name: t.schema for t in TABLES}
    assert (tables["sellers"].count(), spark.table("one_write.sellers_rejected").count()) == (0, 1)
    assert spark.table("one_write.customers_rejected").count() == 0
    rejected = spark.table("one_write.order_payments_rejected").orderBy("line").collect()
    assert [(r.line, r.reason, r["column"]) for r in rejected] == [(4, "order_id not in orders", "order_id"), (5, "unreadable", "payment_sequential")]
    # A version goes whole: that of this load and the one seen before are left.
    load(spark, folder, "one_write", target, strict=False)
    assert len([f for f in folders(target) if f.startswith("order_payments/")]) == 2


def test_reviews_without_repeated_ids_are_not_compared(spark, places, monkeypatch):
    source, target = places
    plans = []
    store = loading.materialize
    monkeypatch.setattr(loading, "materialize", lambda rows: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or store(rows))
    load(spark, extracts(source), "compared", target, strict=False)
    assert plans and not any("review_comment_message" in line for plan in plans for line in plan.splitlines() if "Aggregate" in line)


def test_a_lenient_load_into_buckets(spark, places):
    source, target = places
    folder = extracts(source, {"orders": GOOD["orders"] + ["o3,c9,shipped,,,,,"]})
    assert counts(load(spark, folder, "lenient_buckets", target, strict=False, buckets=4))["orders"] == 2
    assert sorted(r.order_id for r in open_tables(spark, "lenient_buckets")["orders"].collect()) == ["o1", "o2"]
    rejected = spark.table("lenient_buckets.orders_rejected").collect()
    assert [(r.line, r.reason, r["column"]) for r in rejected] == [(4, "customer_id not in customers", "customer_id")]


@pytest.mark.parametrize("remove_read", [False, True])
def test_rows_judged_lie_on_disk_once(spark, places, monkeypatch, remove_read):
    source, target = places
    folder, before, there = extracts(source), set(os.listdir(shared_folder(spark))), {}
    sets = loading._sets

    def seen(rows, table, *args, **named):
        stored = set(os.listdir(shared_folder(spark))) - before
        there[table.name] = len(stored), (source / f"shop_{table.name}_dataset.csv").exists()
        return sets(rows, table, *args, **named)

    monkeypatch.setattr(loading, "_sets", seen)
    found = counts(load(spark, folder, "stored_once", target, strict=False, at_once=1, remove_read=remove_read))
    assert found == {name: len(rows) for name, rows in GOOD.items()}
    assert there == dict.fromkeys(GOOD, (1, not remove_read))
    assert len(list(source.iterdir())) == (0 if remove_read else len(TABLES))


def test_a_refused_extract_is_not_removed(spark, places):
    source, target = places
    folder = extracts(source, {"orders": GOOD["orders"] + ["o3,c9,shipped,,,,,"]})
    with pytest.raises(LoadError) as raised:
        load(spark, folder, "refused_stays", target, at_once=1, remove_read=True)
    assert raised.value.problems == {"customer_id not in customers": 1}
    left = {file.name for file in source.iterdir()}
    assert "shop_orders_dataset.csv" in left and "shop_customers_dataset.csv" not in left
    assert counts(open_tables(spark, "refused_stays")["customers"].selectExpr("'customers' table_name", "count(*) row_count")) == {"customers": 2}


def shuffled(spark):
    """The files in which shuffled rows lie."""
    places = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for place in places for _, _, files in os.walk(str(place)) for f in files if f.startswith("shuffle_")}


def test_what_jobs_shuffled_goes_with_them(spark, places):
    source, target = places
    repeated = GOOD["order_items"] + GOOD["order_items"][:1]
    folder, before = extracts(source, {"order_items": repeated}), shuffled(spark)
    load(spark, folder, "no_shuffles", target, strict=False)
    rows = spark.range(100).selectExpr("id % 7 as id").distinct()
    loads.write_extracts({"orders": rows}, str(source / "written"))
    assert len(spark.read.csv(loads.extract_path(str(source / "written"), "orders"), header=True).collect()) == 7
    # Removed in the background.
    until = time.monotonic() + 20
    while shuffled(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_query_reads_its_extracts_once(spark, monkeypatch):
    left, finished = [], loads.finished
    monkeypatch.setattr(loads, "finished", lambda rows, database, *folders: left.extend(map(os.listdir, folders[:1])) or finished(rows, database, *folders))
    assert loads.load_refresh(spark, "/root/testdata/sf0.001").count()
    assert left == [[]]
