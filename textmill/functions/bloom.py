"""Bloom filters in built-in functions: a bit array in 64-bit words, built by partial aggregation.

A key sets ``hashes`` bits, one by each of as many hashes. A filter that never says no to a
key that was put in lets rows pass an exact join only where they may match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FALSE_POSITIVES = 0.01
#: Larger filters are not made; the exact join then does without.
MAX_BYTES = 64 << 20


def bloom_size(keys: int, false_positives: float = FALSE_POSITIVES) -> tuple[int, int]:
    """``(words, hashes)`` for so many keys."""
    bits = max(64, math.ceil(-keys * math.log(false_positives) / math.log(2) ** 2))
    words = -(-bits // 64)
    return words, max(1, round(words * 64 / max(1, keys) * math.log(2))) if keys else 1


def _bits(key: Column, words: int, hashes: int) -> list[Column]:
    """The places of a key's bits."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(words * 64)) for i in range(hashes)]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))


def bloom_filter(keys: DataFrame, col: str, words: int, hashes: int) -> DataFrame:
    """One row ``(words array<bigint>)``; tasks combine their bits before the shuffle."""
    places = keys.select(F.explode(F.array(*_bits(F.col(col), words, hashes))).alias("place"))
    word = F.floor(F.col("place") / 64).cast("bigint").alias("word")
    set_ = places.groupBy(word).agg(F.bit_or(_bit(F.col("place"))).alias("bits"))
    every = keys.sparkSession.range(words).withColumnRenamed("id", "word").join(set_, "word", "left")
    row = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(row["bits"].alias("words"))


def might_contain(filter_: DataFrame, key: Column, words: int, hashes: int) -> Column:
    """Whether the key may be among those put in; null for a null key. The filter's one row is
    read once and sent with the tasks, as a scalar subquery."""
    held = filter_.scalar()
    found = F.lit(True)
    for place in _bits(key, words, hashes):
        found = found & (F.get(held, F.floor(place / 64).cast("int")).bitwiseAND(_bit(place)) != 0)
    return F.when(key.isNotNull(), found)
