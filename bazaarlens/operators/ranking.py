"""Top rows, global ranks and tiles without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlens.session import materialize

# Layout of monotonically_increasing_id: partition number above, row number in the low 33 bits.
_ROW_BITS = 33


def top_k(df: DataFrame, by: str, tiebreak: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``tiebreak`` makes the choice deterministic."""
    return df.orderBy(*_largest_first(by, tiebreak)).limit(k)


def _largest_first(by: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(by).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tiebreak]]


def rank_global(df: DataFrame, by: str, tiebreak: Sequence[str], rank: str, total: str) -> DataFrame:
    """Add each row's place among all rows, largest ``by`` first, and the number of rows.

    The sort spreads rows over range partitions of (value, tiebreak), so one very frequent value
    is still cut into many partitions. A row's place is its place in its own partition plus the
    sizes of the partitions before it. The sorted rows are written once: the sizes and the
    places must come from the same partitions, and a second run could cut them elsewhere.
    """
    position = F.monotonically_increasing_id()
    placed = materialize(df.orderBy(*_largest_first(by, tiebreak)).withColumn("_position", position))
    part = F.shiftright("_position", _ROW_BITS)
    within = F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))

    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias(total),
    )
    # One row per sort partition, at most spark.sql.shuffle.partitions of them: safe to broadcast.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + within + 1)
        .drop("_position", "_part", "_before")
    )


def tile_of_rank(rank: Column, total: Column, tiles: int) -> Column:
    """The NTILE number of a place among ``total`` rows: the first tiles get the odd rows."""
    size = _whole_quotient(total, F.lit(tiles))
    larger_tiles = total % tiles
    in_larger = larger_tiles * (size + 1)
    place_after = rank - 1 - in_larger
    return (
        F.when(rank <= in_larger, _whole_quotient(rank - 1, size + 1) + 1)
        .otherwise(larger_tiles + _whole_quotient(place_after, F.greatest(size, F.lit(1))) + 1)
        .cast("int")
    )


def _whole_quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ntile_global(df: DataFrame, tiles: int, by: str, tiebreak: Sequence[str], out: str) -> DataFrame:
    """NTILE over all rows, largest ``by`` first, without a one-task window."""
    ranked = rank_global(df, by, tiebreak, "_rank", "_total")
    return ranked.withColumn(out, tile_of_rank(F.col("_rank"), F.col("_total"), tiles)).drop("_rank", "_total")


def ntile_of_top(df: DataFrame, tiles: int, by: str, tiebreak: Sequence[str], out: str, k: int) -> DataFrame:
    """The ``k`` largest rows, largest first, with their NTILE among *all* rows.

    A leading row's place is known from the leading rows alone; of the others only the number
    matters. Both come from one pass: each task sorts its rows and hands on its first ``k`` and
    its count, so what reaches the last task grows with the number of tasks and not of rows.
    """
    order = _largest_first(by, tiebreak)
    position = F.monotonically_increasing_id()
    within = F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    leading = F.when(within < k, F.struct(*df.columns))
    per_task = (
        df.sortWithinPartitions(*order)
        .withColumn("_position", position)
        .groupBy(F.shiftright("_position", _ROW_BITS).alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"), F.collect_list(leading).alias("_leading"))
    )
    leaders = (
        per_task.withColumn("_total", F.sum("_size").over(Window.partitionBy()))
        .select("_total", F.inline("_leading"))
        .orderBy(*order)
        .limit(k)
    )
    place = F.row_number().over(Window.orderBy(*order))
    return (
        leaders.withColumn("_rank", place)
        .withColumn(out, tile_of_rank(F.col("_rank"), F.col("_total"), tiles))
        .orderBy("_rank")
        .drop("_rank", "_total")
    )
