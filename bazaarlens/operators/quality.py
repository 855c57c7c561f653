"""Table rules as jobs: each returns the rows, keys or counts that break one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows, and keys with a NULL in them, with their row counts."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | has_null)


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Non-NULL references without a parent, with the number of child rows that hold each.

    References are counted before the join and parent keys made distinct, so a hot one is a
    single row on either side.
    """
    references = (
        child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("reference")).agg(F.count(F.lit(1)).alias("row_count"))
    )
    keys = parent.select(F.col(pk).alias("reference")).distinct()
    return references.join(keys, "reference", "left_anti")


def check_violations(df: DataFrame, rule: Column) -> DataFrame:
    """Rows for which ``rule`` is false; a rule that is NULL passes."""
    return df.filter(~rule)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def length_violations(df: DataFrame, limits: Mapping[str, int], keys: Sequence[str] = ()) -> DataFrame:
    """One row per over-long value: the row's ``keys``, the column, and the value's length."""
    checks = [
        F.struct(F.lit(c).alias("column_name"), F.char_length(c).alias("value_length"), F.lit(n).alias("max_length"))
        for c, n in limits.items()
    ]
    too_long = F.filter(F.array(*checks), lambda c: c["value_length"] > c["max_length"])
    return df.select(*keys, F.inline(too_long))
