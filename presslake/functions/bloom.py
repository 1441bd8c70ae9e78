"""A Bloom filter of fixed size over the values of a column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

BITS = 1 << 23
HASHES = 4


@dataclass
class Bloom:
    """``words``: ``BITS`` bits; a value sets one bit for each of ``HASHES`` shifted hashes."""

    words: np.ndarray

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """False only for values that are not in the filter; ``hashes`` are their ``xxhash64``."""
        held = np.ones(len(hashes), bool)
        for i in range(HASHES):
            place = (hashes.view(np.uint64) >> np.uint64(16 * i)) % np.uint64(BITS)
            if i:
                place = (place * np.uint64(0x9E3779B1) + np.uint64(i)) % np.uint64(BITS)
            held &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return held


def bloom_of(df: DataFrame, column: str) -> Bloom:
    """The filter of all values of ``column``; one megabyte, whatever their number.

    The bits are combined per task and by word before they reach the driver, which
    gets ``BITS / 64`` numbers at most.
    """
    bits = F.lit(BITS).cast("long")
    places = []
    for i in range(HASHES):
        place = F.pmod(F.shiftrightunsigned("h", 16 * i), bits) if i else F.expr(f"pmod(pmod(h, {BITS}) + {BITS}, {BITS})")
        places.append(F.pmod(place * F.lit(0x9E3779B1) + i, bits) if i else place)
    hashed = df.select(F.xxhash64(column).alias("h"))
    at = hashed.select(F.explode(F.array(*places)).alias("p"))
    word = F.expr("shiftleft(1L, cast(p % 64 as int))")
    rows = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(word).alias("b")).collect()
    words = np.zeros(BITS // 64, np.int64)
    for row in rows:
        words[row["w"]] = row["b"]
    return Bloom(words.view(np.uint64))
