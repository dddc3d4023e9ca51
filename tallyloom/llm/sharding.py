"""Reproducible shuffle into shards: a Feistel permutation over global row numbers, with cycle walking.

Row numbers 0..N-1 are a total order of the rows; the permutation sends row number i to place p, and place p is slot
p div S of shard p mod S. So shard sizes differ by one at most, slots have no gap, and a row's shard and slot can be
computed from its number alone. Everything is a DataFrame expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

#: Buckets that row numbers are counted in. Each is sorted by itself, and the table of their counts has this many rows.
BUCKETS = 4096
#: Equal rows are numbered as one group and spread out again in runs of this many.
RUN = 4096
ROUNDS = 6
#: Cycle-walking steps that every row left outside [0, n) takes before the exact bound is used.
FEW_STEPS = 8


def feistel(i: Column, n: int, seed: int) -> Column:
    """The place of row number i under a permutation of [0, n): a Feistel network on left * b + right with
    left < a, right < b and a * b just over n, walked along its cycle until it falls below n.

    At most a * b - n places lie outside, which bounds the walk: so many steps always end it.
    """
    if n <= 1:
        return i * 0
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    outside = a * b - n

    def once(x: Column) -> Column:
        left, right = F.floor(x / F.lit(b)), F.pmod(x, F.lit(b))
        for k in range(ROUNDS):
            if k % 2 == 0:
                left = F.pmod(left + F.pmod(F.xxhash64(right.cast("long"), F.lit(seed * ROUNDS + k)), F.lit(a)), F.lit(a))
            else:
                right = F.pmod(right + F.pmod(F.xxhash64(left.cast("long"), F.lit(seed * ROUNDS + k)), F.lit(b)), F.lit(b))
        return (left * F.lit(b) + right).cast("long")

    def walk(x: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x, lambda at, _: F.when(at < n, at).otherwise(once(at)))

    first = once(i.cast("long"))
    if not outside:
        return first
    few = walk(first, min(FEW_STEPS, outside))
    return F.when(first < n, first).otherwise(few if outside <= FEW_STEPS else F.when(few < n, few).otherwise(walk(few, outside)))


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add row_number, 0..N-1 without gaps, in an order that depends on the keys alone.

    Rows are bucketed by a hash of their keys, so no bucket is hot: rows equal in every key are counted before the
    shuffle, numbered as one group and spread out again in runs. Only `keys` are kept. Null keys are values as any.
    """
    counted = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))), "numbered")
    sizes = counted.groupBy("_bucket").agg(F.sum("_n").alias("_size"))
    starts = sizes.select("_bucket", (F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")).alias("_start"))
    within = Window.partitionBy("_bucket").orderBy(*keys)
    at = counted.withColumn("_from", F.sum("_n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    at = at.join(F.broadcast(starts), "_bucket").withColumn("_from", F.col("_from") + F.col("_start"))
    one = at.where("_n = 1").select(*keys, F.col("_from").alias("row_number"))
    runs = at.where("_n > 1").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / RUN).cast("long"))))
    runs = runs.repartition("_from", "_run")
    start = F.col("_from") + F.col("_run") * RUN
    end = F.least(start + RUN, F.col("_from") + F.col("_n")) - 1
    return one.unionByName(runs.select(*keys, F.explode(F.sequence(start, end)).alias("row_number")))


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: every row of docs (doc_id, text, ...) in one shard.

    size is the UTF-8 bytes of the text plus 16 (null text: 16), text_crc32 that of the text (null: of no bytes, 0).
    The law is `rows`: counts of shards are at most one apart; so grown_shard is null. Rows that repeat in doc_id and
    text take neighbouring row numbers and are told apart by nothing else; null doc_ids are values as any. No rows
    give no rows. Other columns are dropped, so their names cannot clash. The order of input files does not matter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select("doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text).alias("text_crc32"))
    rows = numbered(slim, ["doc_id", "size", "text_crc32"])
    n = docs.count()
    place = rows.withColumn("_place", feistel(F.col("row_number"), n, seed))
    return place.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.pmod(F.col("_place"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_place") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
