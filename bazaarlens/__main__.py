"""Two commands: load a folder of extracts, and write the reports as CSV.

    spark-submit --py-files bazaarlens.zip -m bazaarlens load /data/extracts market /data/market
    python -m bazaarlens reports market /data/reports
"""

from __future__ import annotations

import argparse

from bazaarlens import build_session, plans
from bazaarlens.sources import load, open_tables

REPORTS = {
    "monthly_revenue": plans.monthly_revenue,
    "top_categories": plans.top_categories,
    "delivery_by_state": plans.delivery_by_state,
    "payment_breakdown": plans.payment_breakdown,
    "top_sellers": plans.top_sellers,
    "review_by_category": plans.review_by_category,
    "state_volume": plans.state_volume,
    "repeat_customers": plans.repeat_customers,
    "status_breakdown": plans.status_breakdown,
    "customer_lifetime_value": plans.customer_lifetime_value,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="bazaarlens", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    loading = commands.add_parser("load", help="replace a database's tables by the extracts of a folder")
    loading.add_argument("folder")
    loading.add_argument("database")
    loading.add_argument("target", help="folder the tables are written below")
    loading.add_argument("--lenient", action="store_true", help="set bad rows aside instead of stopping")
    loading.add_argument("--buckets", type=int, help="no fewer than spark.sql.shuffle.partitions")
    reporting = commands.add_parser("reports", help="write reports as CSV folders with a header")
    reporting.add_argument("database")
    reporting.add_argument("target", help="folder the reports are written below")
    reporting.add_argument("--only", nargs="+", choices=sorted(REPORTS), default=sorted(REPORTS))
    asked = parser.parse_args(arguments)

    spark = build_session("bazaarlens")
    if asked.command == "load":
        counts = load(spark, asked.folder, asked.database, asked.target, strict=not asked.lenient, buckets=asked.buckets)
        counts.orderBy("table_name").show(truncate=False)
        return
    tables = open_tables(spark, asked.database)
    for name in asked.only:
        # A report has few rows, sorted; one file keeps their order.
        REPORTS[name](tables).coalesce(1).write.mode("overwrite").csv(f"{asked.target}/{name}", header=True)


if __name__ == "__main__":
    main()
