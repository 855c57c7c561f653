"""Distinct counts of several columns at once."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_distinct_each(df: DataFrame, by: str, columns: Mapping[str, str]) -> DataFrame:
    """Per value of ``by`` the number of distinct non-NULL values of each column; ``columns`` maps it to its new name.

    Several distinct counts in one aggregation copy every row once per column before anything is reduced. Here
    each column is counted on its own, from a scan of two columns: its pairs with ``by`` are made distinct, first
    within the tasks, and shuffled by both, so a hot value of ``by`` is spread over its pairs. What is joined
    then has one row per value of ``by``. Best where ``df`` is a table, or little more than its scan.
    """
    counted = [
        df.select(F.col(by).alias(f"_{i}"), F.col(column))
        .distinct()
        .groupBy(f"_{i}")
        .agg(F.count(column).alias(out))
        for i, (column, out) in enumerate(columns.items())
    ]
    # Every value of ``by`` is in all of them, NULL too.
    joined = reduce(lambda a, b: a.join(b, F.col("_0").eqNullSafe(F.col(b.columns[0]))), counted)
    return joined.select(F.col("_0").alias(by), *columns.values())
