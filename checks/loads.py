"""Loads of CSV extracts that Spark writes from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.operators import dedup_keep_first
from bazaarlens.schemas import BY_NAME, MONEY
from bazaarlens.session import dropped_shuffles, remove_at_exit, remove_folder, shared_folder
from bazaarlens.sources import LoadError, load, load_audit, open_tables, read_csv_positional
from checks.proxy_tables import ProxyTables, event_number, source


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated part files: quotes doubled, NULL as nothing, an empty text as two quotes."""
    df.write.csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue='""', mode="overwrite")


def extract_path(folder: str, name: str) -> str:
    return f"{folder}/market_{name}_dataset.csv"


def write_extracts(extracts: Mapping[str, DataFrame], folder: str) -> None:
    """Every table's extract below ``folder``, several at a time, in the order given."""
    with dropped_shuffles(next(iter(extracts.values())).sparkSession):
        with ThreadPoolExecutor(4) as pool:
            written = [pool.submit(write_csv, rows, extract_path(folder, name)) for name, rows in extracts.items()]
        for one in written:
            one.result()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of one query; it goes with the driver, if the query does not remove it."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    return folder


def finished(result: DataFrame, database: str, *folders: str) -> DataFrame:
    """A result of a few rows per table, and all it was taken from removed."""
    spark = result.sparkSession
    rows = spark.createDataFrame(result.collect(), result.schema)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    for folder in folders:
        remove_folder(spark, folder)
    return rows


def extract(name: str, rows: DataFrame, **columns) -> DataFrame:
    """``rows`` in the column order and types of table ``name``; columns not given are NULL."""
    rows = rows.withColumns(columns) if columns else rows
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(c.name) if c.name in present else F.lit(None)).cast("string").alias(c.name)
            for c in BY_NAME[name].columns
        ]
    )


def load_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items written as CSV and read back typed."""
    path = new_folder(spark, "items")
    write_csv(extract("order_items", ProxyTables(spark, sf_dir)["order_items"]), path)
    back = read_csv_positional(spark, path, BY_NAME["order_items"].schema)
    return back.withColumn("order_item_id", F.col("order_item_id").cast("int"))


def load_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, with their quotes and line breaks, as review messages through CSV."""
    path = new_folder(spark, "texts")
    documents = source(spark, sf_dir, "documents")
    reviews = documents.select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        F.lit(5).alias("review_score"),
        F.col("lang").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
    )
    write_csv(extract("order_reviews", reviews), path)
    back = read_csv_positional(spark, path, BY_NAME["order_reviews"].schema)
    return back.select("review_id", "review_comment_title", "review_comment_message")


def count_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per proxy table."""
    return load_audit(ProxyTables(spark, sf_dir))


def write_lines(rows: DataFrame, name: str, line: Column, path: str) -> None:
    """Part files of ready-made CSV lines below the header of table ``name``."""
    header = ",".join(c.name for c in BY_NAME[name].columns)
    # A separator and a quote that no line holds: the one column is written as it is.
    rows.select(line.alias(header)).write.csv(path, header=True, sep="\u0001", quote="\u0002", escape="\u0002", mode="overwrite")


def _people(proxies: ProxyTables) -> dict[str, DataFrame]:
    """Extracts of customers and sellers with texts as long as the tables allow."""
    zip_code = F.lit("01037")
    return {
        "customers": extract(
            "customers",
            proxies["customers"],
            customer_zip_code_prefix=zip_code,
            customer_city=F.col("customer_state"),
            customer_state=F.replace("customer_state", F.lit("NATION_"), F.lit("")),
        ),
        "sellers": extract(
            "sellers",
            proxies["sellers"],
            seller_zip_code_prefix=zip_code,
            seller_state=F.replace("seller_state", F.lit("NATION_"), F.lit("")),
        ),
    }


def _paid(events: DataFrame) -> DataFrame:
    """Two payments per order, numbered 1 and 2."""
    return events.select(
        "event_id",
        F.expr("event_id div 2").alias("order_id"),
        (F.col("event_id") % 2 + 1).alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("value").cast(MONEY).alias("payment_value"),
    )


def _repeated_reviews(events: DataFrame, score: Column) -> DataFrame:
    """Three reviews under each id."""
    return events.select(
        "event_id",
        F.expr("event_id div 3").alias("review_id"),
        F.expr("event_id div 2").alias("order_id"),
        score.alias("review_score"),
        F.col("ts").alias("review_creation_date"),
    )


def load_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of a strict load, and of a second one that buckets tables and finds no payments."""
    proxies, events = ProxyTables(spark, sf_dir), source(spark, sf_dir, "events")
    items = proxies["order_items"]
    order = [c for c in items.columns if c not in ("order_id", "order_item_id")]
    reviews = _repeated_reviews(events, event_number() % 5 + 1)
    extracts = _people(proxies) | {
        "order_items": extract("order_items", dedup_keep_first(items, ["order_id", "order_item_id"], order)),
        "order_payments": extract("order_payments", _paid(events)),
        "order_reviews": extract("order_reviews", reviews),
    }
    extracts |= {name: extract(name, proxies[name]) for name in ("product_category_name_translation", "products", "orders")}
    folder, tables = new_folder(spark, "extracts"), new_folder(spark, "tables")
    write_extracts(extracts, folder)
    database = f"load_{uuid.uuid4().hex}"
    # The second load replaces the tables that the first count would still read.
    before = {r.table_name: r.row_count for r in load(spark, folder, database, tables).collect()}
    remove_folder(spark, extract_path(folder, "order_payments"))
    counted = load(spark, folder, database, tables, buckets=4).withColumnRenamed("row_count", "second_load")
    first_load = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("table_name")]
    result = counted.select("table_name", first_load.alias("first_load"), "second_load")
    return finished(result, database, folder, tables)


def load_lenient_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows taken and set aside per table and reason, from whole tables that break every kind of rule.

    Ids that are too long, missing values, numbers and dates that are none, short and long rows, scores
    out of range, repeated keys, orders whose customer and children whose order was set aside,
    and repeated reviews of which the earliest refer to no order.
    """
    folder = new_folder(spark, "extracts")
    proxies, events = ProxyTables(spark, sf_dir), source(spark, sf_dir, "events")
    people = _people(proxies)
    customer, seller = F.col("customer_id").cast("long"), F.col("seller_id").cast("long")
    long_id = F.when(customer % 40 == 1, F.lpad("customer_id", 33, "0")).otherwise(F.col("customer_id"))
    bad_date = F.when(F.col("order_id").cast("long") % 40 == 2, "2017-02-30 10:56:33").otherwise(F.col("order_purchase_timestamp"))
    name_length = F.when(F.col("product_id").cast("long") % 50 == 0, "70000")
    reviews = _repeated_reviews(events, event_number() % 7)
    order_id = F.when(F.col("event_id") % 9 == 0, F.lit(-1)).otherwise(F.col("order_id"))
    extracts = {
        "customers": people["customers"].withColumn("customer_id", long_id),
        "sellers": people["sellers"].withColumn("seller_city", F.when(seller % 5 != 0, F.col("seller_city"))),
        "products": extract("products", proxies["products"]).withColumn("product_name_lenght", name_length),
        "orders": extract("orders", proxies["orders"]).withColumn("order_purchase_timestamp", bad_date),
        "order_items": extract("order_items", proxies["order_items"]),
        "order_reviews": extract("order_reviews", reviews.withColumn("order_id", order_id)),
    }
    write_extracts(extracts, folder)
    paid = _paid(events)
    fields = [F.col(c.name).cast("string") for c in BY_NAME["order_payments"].columns]
    line = (
        F.when(F.col("event_id") % 20 == 3, F.concat_ws(",", *fields[:2]))
        .when(F.col("event_id") % 20 == 4, F.concat_ws(",", *fields, F.lit("more")))
        .otherwise(F.concat_ws(",", *fields))
    )
    write_lines(paid, "order_payments", line, f"{folder}/order_payments.csv")
    return _outcomes(spark, folder, [*extracts, "order_payments"])


def load_null_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that are NULL, empty or text, told apart below a header that begins with a byte order mark."""
    path = new_folder(spark, "marked")
    documents = source(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 3
    reviews = documents.select(
        F.col("doc_id").alias("review_id"),
        F.col("doc_id").alias("order_id"),
        F.lit(5).alias("review_score"),
        F.when(kind == 1, "").when(kind == 2, F.col("lang")).alias("review_comment_title"),
        F.when(kind == 2, F.col("text")).when(kind == 0, "").alias("review_comment_message"),
    )
    write_csv(extract("order_reviews", reviews).withColumnRenamed("review_id", "\ufeffreview_id"), path)
    back = read_csv_positional(spark, path, BY_NAME["order_reviews"].schema)
    title = F.col("review_comment_title")
    return back.select(
        "review_id",
        F.when(title.isNull(), "null").when(title == "", "empty").otherwise(F.concat(F.lit("text "), title)).alias("title"),
        F.coalesce(F.char_length("review_comment_message"), F.lit(-1)).alias("message_length"),
    )


def _outcomes(spark: SparkSession, folder: str, names: Iterable[str]) -> DataFrame:
    """A lenient load: rows taken, and rows set aside for each reason, per table."""
    database, tables = f"load_{uuid.uuid4().hex}", new_folder(spark, "tables")
    taken = load(spark, folder, database, tables, strict=False, remove_read=True)
    outcome = taken.select("table_name", F.lit("accepted").alias("outcome"), "row_count")
    for name in names:
        set_aside = spark.table(f"{database}.{name}_rejected")
        reasons = set_aside.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("row_count"))
        outcome = outcome.union(reasons.select(F.lit(name).alias("table_name"), "outcome", "row_count"))
    return finished(outcome, database, folder, tables)


def load_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole lenient load of extracts: rows taken and set aside per table and reason.

    The extracts break rules on purpose: item keys repeat, payment numbers and review scores
    leave their ranges, and there is no file for geolocation.
    """
    folder = new_folder(spark, "extracts")
    proxies = ProxyTables(spark, sf_dir)
    messages = source(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("review_id"), F.col("text").alias("review_comment_message")
    )
    scores = source(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.expr("event_id div 2").alias("order_id"),
        (event_number() % 7).alias("review_score"),
        F.col("ts").alias("review_creation_date"),
    )
    extracts = _people(proxies) | {
        "order_reviews": extract("order_reviews", scores.join(messages, "review_id", "left")),
    }
    plain = ["product_category_name_translation", "products", "orders", "order_items", "order_payments"]
    extracts |= {name: extract(name, proxies[name]) for name in plain}
    # First those whose making shuffles much: that is gone before the others are on disk.
    joined = ("order_reviews", "orders", "customers")
    write_extracts({name: extracts[name] for name in joined}, folder)
    write_extracts({name: rows for name, rows in extracts.items() if name not in joined}, folder)

    return _outcomes(spark, folder, extracts)


def load_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a strict load that was refused at the items, and why it was: keys repeat, and half the
    sellers are missing.

    The database was full before: tables up to the items are new, the items and all behind them empty.
    """
    proxies, events = ProxyTables(spark, sf_dir), source(spark, sf_dir, "events")
    items = proxies["order_items"]
    order = [c for c in items.columns if c not in ("order_id", "order_item_id")]
    folder, tables = new_folder(spark, "extracts"), new_folder(spark, "tables")
    names = ("product_category_name_translation", "products", "orders")
    extracts = _people(proxies) | {name: extract(name, proxies[name]) for name in names}
    extracts["order_payments"] = extract("order_payments", _paid(events))
    unique = dedup_keep_first(items, ["order_id", "order_item_id"], order)
    write_extracts(extracts | {"order_items": extract("order_items", unique)}, folder)

    database = f"load_{uuid.uuid4().hex}"
    load(spark, folder, database, tables)
    # Half as many sellers in the second load tell its tables from those of the first.
    even = extracts["sellers"].filter(F.col("seller_id").cast("long") % 2 == 0)
    write_extracts({"sellers": even, "order_items": extract("order_items", items)}, folder)
    refused: dict[str, int] = {}
    table = None
    try:
        load(spark, folder, database, tables)
    except LoadError as error:
        refused, table = error.problems, error.table
    problems = ", ".join(f"{rule}: {cases}" for rule, cases in sorted(refused.items()))
    seen = load_audit(open_tables(spark, database))
    problem = F.when(F.col("table_name") == F.lit(table), F.lit(problems)).alias("problem")
    return finished(seen.select("table_name", "row_count", problem), database, folder, tables)


def _dealt(lines: DataFrame, header: str, parts: int) -> DataFrame:
    """Rows of (part, place, line) and a header for each part, every part in a task of its own: a file has one writer, which
    gets the rows of this file and no others."""
    headers = lines.sparkSession.range(parts).select(
        F.col("id").cast("int").alias("part"), F.lit(-1).cast("long").alias("place"), F.lit(header).alias("line")
    )
    return lines.unionByName(headers).repartitionById(parts, F.col("part"))


def _write_files(lines: DataFrame, header: str, parts: int, path: str) -> None:
    """Rows of (part, place, line) as one file per part, in the order of their places below a header."""
    together = _dealt(lines, header, parts).sortWithinPartitions("part", "place")
    together.select("part", "line").write.partitionBy("part").text(path)


def load_fault_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File, line and column of every row that a lenient load sets aside, from whole documents as review messages.

    Messages of many lines move all that stands below them. Some rows hold a score that is no number or out of
    range, bytes that are no text, too few fields, or no order.
    """
    folder, tables, parts = new_folder(spark, "extracts"), new_folder(spark, "tables"), 8
    documents = source(spark, sf_dir, "documents")
    doc = F.col("doc_id").cast("string")
    people = documents.select(
        doc.alias("customer_id"), doc.alias("customer_unique_id"), F.lit("01037").alias("customer_zip_code_prefix"),
        F.lit("sao paulo").alias("customer_city"), F.lit("SP").alias("customer_state"),
    )
    orders = documents.select(doc.alias("order_id"), doc.alias("customer_id"), F.lit("shipped").alias("order_status"))
    write_csv(extract("customers", people), f"{folder}/customers.csv")
    write_csv(extract("orders", orders), f"{folder}/orders.csv")

    kind = F.col("doc_id") % 50
    message = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    score = F.when(kind == 7, "x9").when(kind == 19, "9").otherwise("5")
    order_id = F.when(kind == 17, "").otherwise(doc)
    title = F.when(kind == 11, F.concat(F.lit(b"t"), F.lit(b"\xff\xfe")).cast("string")).otherwise(F.lit("t"))
    whole = F.concat_ws(",", doc, order_id, score, title, message, F.lit(""), F.lit(""))
    line = F.when(kind == 13, F.concat_ws(",", doc, order_id, score)).otherwise(whole)
    header = ",".join(c.name for c in BY_NAME["order_reviews"].columns)
    lines = documents.select((F.col("doc_id") % parts).cast("int").alias("part"), F.col("doc_id").alias("place"), line.alias("line"))
    _write_files(lines, header, parts, f"{folder}/order_reviews.csv")

    database = f"load_{uuid.uuid4().hex}"
    load(spark, folder, database, tables, strict=False)
    set_aside = spark.table(f"{database}.order_reviews_rejected")
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("int").alias("part")
    return set_aside.select(part, "line", "reason", F.col("column").alias("column_name"))


def load_first_in_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of three reviews under each id a strict load keeps that goes by their place in the files."""
    folder, tables, parts = new_folder(spark, "extracts"), new_folder(spark, "tables"), 4
    proxies, events = ProxyTables(spark, sf_dir), source(spark, sf_dir, "events")
    for name in ("customers", "orders"):
        rows = _people(proxies)[name] if name == "customers" else extract(name, proxies[name])
        write_csv(rows, f"{folder}/{name}.csv")
    reviews = _repeated_reviews(events, event_number() % 5 + 1)
    line = F.concat_ws(
        ",", F.col("review_id"), F.col("order_id"), F.col("review_score"), F.col("event_id"), F.lit(""),
        F.date_format("review_creation_date", "yyyy-MM-dd HH:mm:ss"), F.lit(""),
    )
    header = ",".join(c.name for c in BY_NAME["order_reviews"].columns)
    part = (F.col("event_id") % parts).cast("int").alias("part")
    # The files run backwards in time.
    lines = reviews.select(part, (F.lit(1 << 40) - F.col("event_id")).alias("place"), line.alias("line"))
    _write_files(lines, header, parts, f"{folder}/order_reviews.csv")
    database = f"load_{uuid.uuid4().hex}"
    load(spark, folder, database, tables, first="in_file")
    kept = open_tables(spark, database)["order_reviews"]
    return kept.select("review_id", "order_id", F.col("review_comment_title").alias("event_id"))
