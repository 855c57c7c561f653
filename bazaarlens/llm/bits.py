"""Sets of 64-bit keys as bit tables of bounded size, for tasks that must know early what may be of use.

A key's low bits are its place. Where two keys share one, a key that is not in the set is found in it; one that is in
it always is. So such a table saves work and decides nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A table has 16 bits for each key, but never more than 128 MB.
LEAST_BITS = 20
MOST_BITS = 30


@dataclass
class Bits:
    table: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        bits = keys & np.uint64(len(self.table) * 8 - 1)
        return (self.table[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bit_table(keys: DataFrame) -> Broadcast:
    """The stored rows of one long column as a bit table in every task."""
    spark, (name,) = keys.sparkSession, keys.columns
    count = 1 << max(LEAST_BITS, min((16 * keys.count()).bit_length(), MOST_BITS))
    numbered = keys.select((F.col(name).bitwiseAND(F.lit(count - 1)) + 1).alias("bit"))
    blocks = numbered.groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    table = np.zeros(count // 8, dtype=np.uint8)
    for batch in blocks.toArrow().to_batches():
        for block, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(bits.as_buffer(), dtype=np.uint8)
            at = (block - 1) * 4096
            table[at : at + len(part)] = part[: len(table) - at]
    return spark.sparkContext.broadcast(Bits(table))
