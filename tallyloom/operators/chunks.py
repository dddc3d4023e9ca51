"""Greedy chunks of a store's products under two budgets, with a store split among tasks.

Where a chunk that begins at a product ends depends on the next few products only, as a chunk holds no more than its
budget. So each block of products says, for every place at its head where a chunk may begin, at which place of the next
block the walk goes on, and how many chunks it began. These small functions compose, a few hundred blocks at a time and again
until a store has one; going down again, each block learns where the walk enters it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: Products of a block (the product budget at least), and blocks that are composed at a time.
BLOCK, FAN = 4096, 256


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _positions(products: DataFrame, store: str, order: str, block: int, most_images: int | None) -> DataFrame:
    """store, order, urls, pos (0, 1, ... in a store), with rows dealt out by ranges of store and order."""
    images = F.coalesce("images", F.array().cast("array<string>"))
    images = F.slice(images, 1, most_images) if most_images is not None else images
    urls = F.array_distinct(F.filter(F.transform(images, lambda u: F.trim(u)), lambda u: u.isNotNull() & (u != "")))
    rows = products.select(F.col(store).alias("store"), F.col(order).alias("ord"), urls.alias("urls")).repartitionByRange("store", "ord", "urls")
    rows = _kept(rows.withColumn("part", F.spark_partition_id()), "ranges")  # ranges are sampled, so they are taken once
    counts = rows.groupBy("store", "part").agg(F.count("*").alias("n"))
    base = counts.select(F.col("store").alias("_store"), F.col("part").alias("_part"), (F.sum("n").over(Window.partitionBy("store").orderBy("part")) - F.col("n")).alias("base"))
    within = F.row_number().over(Window.partitionBy("store", "part").orderBy("ord", "urls"))
    on = F.col("_store").eqNullSafe(F.col("store")) & (F.col("_part") == F.col("part"))
    return rows.withColumn("k", within).join(base, on).select("store", "ord", "urls", (F.col("base") + F.col("k") - 1).alias("pos")).withColumn("block", F.floor(F.col("pos") / block))


def _nexts(block: int, most_products: int, most_urls: int):
    """Of a block's rows (and those of the next one that it may look at), where a chunk that begins there ends."""

    def run(pdf):
        pdf = pdf.sort_values("pos", ignore_index=True)
        urls, pos = list(pdf["urls"]), pdf["pos"].tolist()
        own = int((pdf["pos"] // block == pdf["at"]).sum())
        held: dict[str, int] = {}
        end, out = 0, []
        for k in range(own):
            while end < len(urls) and end - k < most_products:
                if end > k and len(held) + sum(u not in held for u in urls[end]) > most_urls:
                    break
                for u in urls[end]:
                    held[u] = held.get(u, 0) + 1
                end += 1
            out.append(pos[k] + end - k)
            for u in urls[k]:
                held[u] -= 1
                if not held[u]:
                    del held[u]
        return pdf.iloc[:own][["store", "ord", "pos"]].assign(block=pdf["at"].iloc[:own], next=out)

    return run


def _walk(nexts, base: int, at: int, end: int) -> tuple[int, list[int]]:
    """From position `at` on: where the walk leaves the block, and the chunks' first places in it."""
    starts = []
    while at < end:
        starts.append(at)
        at = nexts[at - base]
    return at, starts


def _heads(block: int, places: int):
    """A block's function: for each place at its head the place of the next block, and the chunks begun."""

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("pos", ignore_index=True)
        base, nexts = int(pdf["block"].iloc[0]) * block, pdf["next"].tolist()
        end = base + len(nexts)
        goes, begun = [], []
        for e in range(places):
            at, starts = _walk(nexts, base, base + e, end)
            goes.append(min(max(at - base - block, 0), places - 1))
            begun.append(len(starts))
        return pd.DataFrame({"store": pdf["store"].iloc[:1], "block": pdf["block"].iloc[:1], "goes": [goes], "begun": [begun]})

    return run


def _labels(block: int):
    def run(pdf):
        pdf = pdf.sort_values("pos", ignore_index=True)
        base, enter, before = int(pdf["block"].iloc[0]) * block, int(pdf["enter"].iloc[0]), int(pdf["before"].iloc[0])
        _, starts = _walk(pdf["next"].tolist(), base, base + enter, base + len(pdf))
        chunk = pdf["pos"].isin(starts).cumsum() + before - 1
        return pdf[["store", "ord"]].assign(chunk=chunk)

    return run


def budget_chunks(products: DataFrame, store: str, order: str, most_products: int, most_urls: int, most_images: int | None = None, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """store, order column, chunk: consecutive products of a store in chunks of at most so many products and different
    image urls (of the first `most_images` of each product; blanks and nulls don't count; a product is never cut, so one
    with more urls than that is a chunk).

    Products of the same order go by their urls. A task holds a block of products and what its last chunk may reach into the
    next; no task holds a store. Null stores are one store.
    """
    block = max(block, most_products)
    rows = _positions(products, store, order, block, most_images)
    rows = rows.select("*", F.explode(F.when((F.pmod("pos", F.lit(block)) < most_products) & (F.col("block") > 0), F.array(F.col("block"), F.col("block") - 1)).otherwise(F.array("block"))).alias("at"))
    kinds = dict(products.select(store, order).dtypes)
    keys = f"store {kinds[store]}, ord {kinds[order]}"
    nexts = _kept(rows.select("store", "ord", "urls", "pos", "at").groupBy("store", "at").applyInPandas(_nexts(block, most_products, most_urls), f"{keys}, pos long, block long, next long"), "nexts")

    functions = f"store {kinds[store]}, block long, goes array<int>, begun array<long>"
    levels = [_kept(nexts.groupBy("store", "block").applyInPandas(_heads(block, most_products), functions), "heads")]
    listed = lambda *names: F.array_sort(F.collect_list(F.struct("block", *names)))
    start = F.struct(F.sequence(F.lit(0), F.lit(most_products - 1)).cast("array<int>").alias("goes"), F.array_repeat(F.lit(0).cast("long"), most_products).alias("begun"))
    both = lambda a, x: F.struct(F.transform(a["goes"], lambda e: F.get(x["goes"], e)).alias("goes"), F.transform(F.arrays_zip(a["goes"], a["begun"]), lambda z: z["begun"] + F.get(x["begun"], z["goes"])).alias("begun"))
    while levels[-1].agg(F.max("block")).first()[0]:
        up = levels[-1].withColumn("above", F.floor(F.col("block") / fan)).groupBy("store", "above").agg(listed("goes", "begun").alias("all"))  # fan rows at most
        up = up.withColumn("f", F.aggregate("all", start, both)).select("store", F.col("above").alias("block"), "f.goes", "f.begun")
        levels.append(_kept(up, "heads"))
    # down again: where the walk enters each block, and the chunks begun before it
    step = lambda a, x: F.struct(F.get(x["goes"], a["enter"]).alias("enter"), (a["before"] + F.get(x["begun"], a["enter"])).alias("before"), F.concat(a["out"], F.array(F.struct(x["block"].alias("block"), a["enter"].alias("enter"), a["before"].alias("before")))).alias("out"))
    entries = levels.pop().select("store", "block", F.lit(0).alias("enter"), F.lit(0).cast("long").alias("before"))
    while levels:
        below = levels.pop().withColumn("above", F.floor(F.col("block") / fan)).groupBy("store", "above").agg(listed("goes", "begun").alias("all"))
        e = entries.select(F.col("store").alias("_store"), F.col("block").alias("_block"), "enter", "before")
        zero = F.struct(F.col("enter"), F.col("before"), F.array().cast("array<struct<block:bigint,enter:int,before:bigint>>").alias("out"))
        met = below.join(e, F.col("store").eqNullSafe(F.col("_store")) & (F.col("above") == F.col("_block")))
        entries = _kept(met.select("store", F.explode(F.aggregate("all", zero, step)["out"]).alias("x")).select("store", "x.*"), "entries")
    e = entries.select(F.col("store").alias("_store"), F.col("block").alias("_block"), "enter", "before")
    whole = nexts.join(e, F.col("store").eqNullSafe(F.col("_store")) & (F.col("block") == F.col("_block"))).select("store", "ord", "pos", "block", "next", "enter", "before")
    found = whole.groupBy("store", "block").applyInPandas(_labels(block), f"{keys}, chunk long")
    return found.select(F.col("store").alias(store), F.col("ord").alias(order), "chunk")
