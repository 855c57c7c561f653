"""Operators over already aggregated rows: one row per month, segment, status or category.

Their windows have no partition key and so run in one task. That is sound only because the
input holds one row per group of a small vocabulary; never hand them raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.functions.numeric import percent


def period_change(
    df: DataFrame, period: str, value: str, previous: str, change: str, digits: int = 2, scale: int = 2
) -> DataFrame:
    """Add the value of the previous present period and the change from it in percent.

    Periods that are missing are not filled in. The change is NULL in the first period and
    after a period with value 0.
    """
    in_order = Window.orderBy(F.col(period).asc_nulls_last())
    with_previous = df.withColumn(previous, F.lag(value, 1).over(in_order))
    return with_previous.withColumn(
        change, percent(F.col(value) - F.col(previous), F.col(previous), digits, scale=scale)
    )


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 2, scale: int = 0) -> DataFrame:
    """Add each row's ``value`` in percent of the sum over all rows."""
    total = F.sum(value).over(Window.partitionBy())
    return df.withColumn(out, percent(F.col(value), total, digits, scale=scale))


def running_share(
    df: DataFrame, value: str, tiebreak: str, out: str, digits: int = 2, scale: int = 0
) -> DataFrame:
    """Add the share of the total that the rows with the largest values down to this one hold."""
    largest_first = Window.orderBy(F.col(value).desc_nulls_first(), F.col(tiebreak).asc_nulls_last())
    so_far = F.sum(value).over(largest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum(value).over(Window.partitionBy())
    return df.withColumn(out, percent(so_far, total, digits, scale=scale))


def bucketize(value: Column, buckets: Sequence[tuple[int, int | None, str]]) -> Column:
    """The label of the first ``(low, high, label)`` that holds ``value``; both ends are in it.

    A ``high`` of None leaves the bucket open above.
    """
    label = F.lit(None).cast("string")
    for low, high, name in reversed(buckets):
        inside = value >= low if high is None else value.between(low, high)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label
