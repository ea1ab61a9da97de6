"""A filter of fixed size for 64-bit keys, built by Spark and small enough to send to all tasks.

It never misses a key that was put in; it may pass others, so what passes is joined exactly
afterwards. Its size follows the number of keys up to ``MAX_BITS`` and never beyond: with more
keys it only passes more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS = 16, 26
BITS_PER_KEY = 16


class KeyFilter:
    def __init__(self, bits: int, words: np.ndarray) -> None:
        self.bits, self.words = bits, words

    def passes(self, keys: np.ndarray) -> np.ndarray:
        at = keys.astype("u8", copy=False) >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def key_filter(keys: DataFrame, column: str) -> KeyFilter:
    """From a long column of well mixed hashes. At most 2^20 numbers come to the driver."""
    n = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, (max(1, n) * BITS_PER_KEY - 1).bit_length()))
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = keys.where(F.col(column).isNotNull()).select(
        F.shiftrightunsigned(place, 6).alias("word"),
        F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({column}, {64 - bits}) & 63 AS INT))").alias("bit"),
    )
    words = np.zeros(1 << (bits - 6), "u8")
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view("u8")
    return KeyFilter(bits, words)
