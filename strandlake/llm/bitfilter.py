"""A bit filter of fixed size over 64-bit keys: leaves out rows that cannot match before they are shuffled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2^25 bits, 4 MB at any size of the input.
BITS = 25


class BitFilter:
    """May say yes for a key it does not hold, never no for one it does.

    The bits are set by a distributed aggregation into 64-bit words; the driver gets at most 2^19 words and sends them
    along with the function that uses them. When the held keys outgrow the bits it lets everything through, so callers
    must join afterwards; nothing but shuffle volume depends on it.
    """

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, df: DataFrame, key: str) -> BitFilter:
        place = F.shiftrightunsigned(F.col(key), 64 - BITS)
        bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({key}, {64 - BITS}) & 63 as int))")
        found = df.select(F.shiftright(place, 6).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(
            F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(1 << (BITS - 6), np.int64)
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        return cls(words.view(np.uint64))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        place = keys.view(np.uint64) >> np.uint64(64 - BITS)
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
