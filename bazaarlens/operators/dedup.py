"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in ``order`` (ascending, NULLs last).

    Name enough columns in ``order`` to make it total; the result is then the same on every run
    and under every partitioning. The filter on the row number lets Spark drop all but one row
    per key before the shuffle, so a key with very many copies does not reach one task whole.
    """
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")
