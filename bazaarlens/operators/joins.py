"""A join that keeps hot keys from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Keys are counted by hash bucket, so the count is a small table whatever the number of keys.
_BUCKETS = 1 << 16
# A bucket this many times the mean is hot. Fewer than _BUCKETS / _HOT_FACTOR buckets can be.
_HOT_FACTOR = 4
# Below this a bucket is no burden for one task.
_MIN_SLICE_ROWS = 200_000


def spread_join(
    rows: DataFrame,
    side: DataFrame,
    on: str | Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    min_slice_rows: int = _MIN_SLICE_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many ``rows`` to a ``side`` with one row per key, splitting the hot keys.

    Adaptive skew handling only splits joins whose two inputs come straight from a shuffle. It
    leaves a join to an aggregated side alone, which is where this one is used.

    Hot hash buckets are found from counts over all rows, and their rows cut into slices by a
    hash of ``spread_by`` (columns that tell rows of one key apart). Side rows of those buckets
    are repeated once per slice. The slices add up to at most twice ``_BUCKETS / _HOT_FACTOR``,
    and a bucket holds a 1 / ``_BUCKETS`` share of the side's keys, so the repetition adds at
    most half the side in the worst case. Nothing is dropped; the result equals the plain join.

    ``counted`` names rows with the same keys that are cheaper to count than ``rows``, such as
    the stored rows that ``rows`` was joined from.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"spread_join supports inner and left, not {how}")
    keys = [on] if isinstance(on, str) else list(on)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))

    sizes = (rows if counted is None else counted).groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    slice_rows = F.greatest(
        F.lit(min_slice_rows), F.ceil(F.sum("_size").over(Window.partitionBy()) * _HOT_FACTOR / _BUCKETS)
    )
    hot = (
        sizes.withColumn("_slice_rows", slice_rows)
        .filter(F.col("_size") > F.col("_slice_rows"))
        .select("_bucket", F.ceil(F.col("_size") / F.col("_slice_rows")).cast("int").alias("_slices"))
    )
    # Fewer than 2^14 rows of two integers, by the definition of hot: safe to broadcast.
    hot = F.broadcast(hot)

    slice_of_row = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_slices")), F.lit(0)).cast("int")
    sliced_rows = (
        rows.withColumn("_bucket", bucket)
        .join(hot, "_bucket", "left")
        .withColumn("_slice", slice_of_row)
        .drop("_bucket", "_slices")
    )
    all_slices = F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)
    sliced_side = (
        side.withColumn("_bucket", bucket)
        .join(hot, "_bucket", "left")
        .withColumn("_slice", F.explode(all_slices))
        .drop("_bucket", "_slices")
    )
    return sliced_rows.join(sliced_side, [*keys, "_slice"], how).drop("_slice")
