"""A bitmap of 64-bit keys by their last bits, of one size whatever the corpus.

It keeps rows that a join cannot want out of its shuffle: every key that went
in is found again, others mostly are not.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

#: Bits of a key that count; the bitmap has 2**BITS bits.
BITS = 26
_BUCKET = 1 << 15  # positions in a bucket of Spark's bitmap functions


def build(df: DataFrame, key: str) -> np.ndarray:
    """The bitmap of a column's keys; a row per bucket comes to the driver."""
    spot = F.col(key).bitwiseAND(F.lit((1 << BITS) - 1)) + 1
    parts = df.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    out = np.zeros((1 << BITS) >> 3, np.uint8)
    # bucket number k has the positions from (k - 1) * 2**15 + 1 on
    for row in parts.collect():
        at = (row["bucket"] - 1) * (_BUCKET >> 3)
        out[at : at + (_BUCKET >> 3)] = np.frombuffer(row["bits"], np.uint8)
    return out


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    spot = (keys.astype(np.int64) & ((1 << BITS) - 1)).astype(np.int64)
    return (table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 > 0
