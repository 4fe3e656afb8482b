"""A Bloom filter of bounded size, built by one aggregate and tested in the scan.

The filter is an array of 64-bit words that one aggregate makes and a scalar subquery
hands to the tasks, so its size is bounded by ``max_bytes`` however many keys there are;
with more keys only its error grows, and the exact join after it stays exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BYTES = 8 << 20
BITS_PER_KEY = 10
HASHES = 4


def filter_words(n_keys: int, bits_per_key: int = BITS_PER_KEY, max_bytes: int = MAX_BYTES) -> int:
    """64-bit words of the filter: ``bits_per_key`` bits a key, ``max_bytes`` at most."""
    return max(1, min(-(-n_keys * bits_per_key // 64), max_bytes // 8))


def bloom_test(keys: DataFrame, *, bits_per_key: int = BITS_PER_KEY, hashes: int = HASHES,
               max_bytes: int = MAX_BYTES) -> Callable[[Column], Column]:
    """A test for membership in the one column of ``keys``: true for every key and for a few other values.

    At 10 bits a key and 4 hashes about 1.2 % of other values pass.  A null value fails.
    """
    key = F.col(keys.columns[0])
    words = filter_words(keys.count(), bits_per_key, max_bytes)

    def place(k: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(i), k), F.lit(words * 64))

    def word(p: Column) -> Column:
        return F.shiftright(p, 6).cast("int")

    def bit(p: Column) -> Column:
        return p.bitwiseAND(F.lit(63)).cast("int")

    places = keys.where(key.isNotNull()).select(F.explode(F.array(*[place(key, i) for i in range(hashes)])).alias("p"))
    masks = (places.select(word(F.col("p")).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col("p"))).alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")))
    every = keys.sparkSession.range(0, words, 1, 1).select(F.col("id").cast("int").alias("word")).join(masks, "word", "left")
    packed = F.sort_array(F.collect_list(F.struct("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))))
    table = every.agg(packed.alias("t")).select("t.mask").scalar()

    def test(value: Column) -> Column:
        hit = [F.call_function("getbit", F.get(table, word(p)), bit(p)) == 1 for p in (place(value, i) for i in range(hashes))]
        return value.isNotNull() & reduce(and_, hit)

    return test
