"""Set differences that shuffle only what a Bloom filter cannot tell."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits a key and hash functions: about one false positive in a hundred. A filter has no more than MOST_BITS bits (8 MB): with
#: more keys than that is enough for it lets more pass, and what passes is checked.
BITS_A_KEY, HASHES, MOST_BITS = 10, 5, 1 << 26


def _place(keys: list[str], k: int, bits: Column | int) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), *keys), F.lit(bits) if isinstance(bits, int) else bits)


def bloom(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row (words, bits): a Bloom filter of the keys of rows, sized from their number. Bits are set in words of 64, which
    are united before the shuffle; the last step has a row a word."""
    n = rows.count()
    bits = min(MOST_BITS, max(64, 1 << (n * BITS_A_KEY - 1).bit_length() if n else 64))
    places = rows.select(F.explode(F.array(*(_place(keys, k, bits) for k in range(HASHES)))).alias("at"))
    words = places.groupBy(F.floor(F.col("at") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("x"))
    whole = rows.sparkSession.range(bits // 64).withColumnRenamed("id", "w").join(words, "w", "left")
    return whole.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("x", F.lit(0).cast("long")).alias("x")))).alias("all")).select(F.col("all.x").alias("words"), F.lit(bits).cast("long").alias("bits"))


def may_hold(keys: list[str]) -> Column:
    """Whether the filter of a row joined to it may hold a row's keys; never false where it does."""

    def one(k: int) -> Column:
        at = _place(keys, k, F.col("bits"))
        word = F.get("words", F.floor(at / 64).cast("int"))
        return F.call_function("shiftrightunsigned", word, F.pmod(at, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1

    return reduce(lambda a, b: a & b, (one(k) for k in range(HASHES)))


def difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left whose keys are not in right (a null in them is in nothing), as a left anti join gives them.

    What a filter of right's keys does not hold is told at once, where it lies; the rest of left, and what of right a filter of
    that rest may hold, is joined. Both filters are of a bounded size and are broadcast.
    """
    held = F.broadcast(bloom(right.select(*keys), keys))
    sure = left.join(held, may_hold(keys), "left_anti")
    maybe = left.join(held, may_hold(keys), "left_semi")
    other = right.select(*keys).join(F.broadcast(bloom(maybe.select(*keys), keys)), may_hold(keys), "left_semi")
    return sure.unionByName(maybe.join(other, keys, "left_anti"))
