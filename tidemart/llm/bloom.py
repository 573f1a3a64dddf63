"""A Bloom filter of bounded size that tasks use to drop rows before a join.

The join that follows decides; the filter only spares rows the shuffle. Its size has a fixed upper
bound, whatever the data: with more keys it lets more rows pass, and the result is the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BITS = 1 << 26


def filter_words(keys: DataFrame, key: Column, max_bits: int = MAX_BITS) -> np.ndarray:
    """The filter over the bigint ``key`` as an array of 64-bit words, at most ``max_bits`` / 64 of them.

    Keys must be well mixed hashes already: two stretches of their own bits are the spots. Words are combined on the executors; the driver gets each non-zero word once.
    """
    rows = keys.select(key.cast("bigint").alias("key")).where("key is not null")
    count = rows.count()
    bits = 1 << 12
    while bits < min(max_bits, 32 * count):
        bits *= 2
    spots = F.array(
        F.pmod("key", F.lit(bits)), F.pmod(F.shiftrightunsigned("key", 32), F.lit(bits))
    )
    words = (
        rows.select(F.explode(spots).alias("spot"))
        .groupBy(F.expr("spot div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("bits"))
        .toArrow()
    )
    found = np.zeros(bits // 64, np.uint64)
    found[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return found


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each unsigned key whether the filter may hold it; false is certain."""
    mask = np.uint64(len(words) * 64 - 1)

    def hit(keys: np.ndarray) -> np.ndarray:
        spot = keys & mask
        return (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) != 0

    found = hit(keys)
    some = np.flatnonzero(found)
    found[some] = hit(keys[some] >> np.uint64(32))
    return found
