"""Sets of numbers as maps of a fixed size, small enough for every task whatever the size of the set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap(numbers: DataFrame, column: str, bits: int) -> np.ndarray:
    """A map of ``bits`` bits in which those of all numbers are set; other numbers may share a bit. ``bits`` is a power of two."""
    bit = F.pmod(column, F.lit(bits)) + 1  # Spark's functions count from 1
    found = numbers.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    whole = np.zeros(bits // 8, np.uint8)
    for row in found:
        own = np.frombuffer(bytes(row["bits"]), np.uint8)
        at = (row["bucket"] - 1) * len(own)
        whole[at:at + len(own)] = own[:len(whole) - at]
    return whole


def on_map(whole: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which of the numbers have their bit set. Numbers that were put on the map always have."""
    at = numbers.view(np.uint64) & np.uint64(8 * len(whole) - 1)
    return (whole[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
