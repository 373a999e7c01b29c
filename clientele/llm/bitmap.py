"""Bitmaps of fixed size over hashes, used to leave rows out before a shuffle.

A bitmap holds the low bits of a set of hashes. Rows outside it cannot join with the set;
rows inside may, and the join decides. Its size does not depend on the set's: a set that
outgrows it only lets more rows pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 32768  # bits of one row of Spark's bitmap_construct_agg


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Of the column ``h`` (long); ``bits`` is a power of two, bits / 8 bytes are collected."""
    bit = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = (hashes.groupBy(F.floor(bit / BUCKET_BITS).cast("int").alias("bucket"))
            .agg(F.bitmap_construct_agg(bit % BUCKET_BITS).alias("bits")).toLocalIterator())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        at = r.bucket * BUCKET_BITS // 8
        out[at:at + BUCKET_BITS // 8] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) & np.uint64(8 * len(bits) - 1)
    return (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
