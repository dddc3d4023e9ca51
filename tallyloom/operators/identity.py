"""Stores and their branches: seeds by domain, first rows, branch assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import geocode_score, house_number, zip_code
from ..functions.urls import clean_optional, domain_key


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key: rank 1 is pushed below the shuffle by Spark's window group limit."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(at)).where("_rank = 1").drop("_rank")


def seed_addresses(cells: Column) -> Column:
    """Cells without blanks and repeats (case aside), first spelling and order kept."""
    kept = F.filter(F.transform(cells, clean_optional), lambda x: x.isNotNull())
    lower = F.transform(kept, F.lower)
    return F.filter(kept, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1)


def dedupe_domain(seeds: DataFrame) -> DataFrame:
    """One seed row for each domain: most addresses, then first seen; first_ord is the domain's first appearance."""
    rows = seeds.withColumn("domain", domain_key(F.col("store_url"))).withColumn("n_addresses", F.size(F.coalesce("addresses", F.array().cast("array<string>"))))
    # both are pre-aggregated before the shuffle, so a hot domain is no hot task; only the chosen rows are joined back
    best = rows.groupBy("domain").agg(F.min("ord").alias("first_ord"), F.max(F.struct("n_addresses", (-F.col("ord")).alias("back"))).alias("best"))
    best = best.select("domain", "first_ord", (-F.col("best.back")).alias("ord"))
    return rows.join(best, ["domain", "ord"]).select("first_ord", "domain", "store_url", "store_name", "addresses", "n_addresses")


def db_first_seeds(stores: DataFrame, seeds: DataFrame) -> DataFrame:
    """Production domains first, with the seed's addresses or else their own, then seeds of unseen domains."""
    known = stores.withColumn("domain", domain_key(F.col("website"))).groupBy("domain").agg(F.min("website").alias("website"), F.min(clean_optional(F.col("address"))).alias("address"))
    seeds = seeds.select("domain", "store_url", "addresses", "first_ord")
    own = F.when(F.col("address").isNotNull(), F.array("address")).otherwise(F.array().cast("array<string>"))
    first = known.join(seeds, "domain", "left").select(F.lit(0).alias("part"), "domain", F.col("website").alias("store_url"), F.when(F.size("addresses") > 0, F.col("addresses")).otherwise(own).alias("addresses"))
    return first.unionByName(seeds.join(known, "domain", "left_anti").select(F.lit(1).alias("part"), "domain", "store_url", "addresses"))


def address_backfill(stores: DataFrame, seeds: DataFrame) -> DataFrame:
    """The first row of a domain whose address is blank gets the first seed address of the domain."""
    first = first_by(stores.withColumn("domain", domain_key(F.col("website"))), ["domain"], F.col("id")).where(clean_optional(F.col("address")).isNull())
    given = seeds.where(F.size("addresses") > 0).select("domain", F.try_element_at("addresses", F.lit(1)).alias("new_address"))
    return first.join(given, "domain").select("id", "domain", "new_address")


def branch_fanout(seeds: DataFrame) -> DataFrame:
    """A row for each address of a store, a store without one keeps a row; the first is the primary."""
    return seeds.select("domain", "store_url", F.posexplode_outer("addresses").alias("pos", "address")).select("domain", "store_url", F.coalesce("pos", F.lit(0)).alias("pos"), "address", (F.coalesce("pos", F.lit(0)) == 0).alias("is_primary"))


def branch_assign(branches: DataFrame, existing: DataFrame) -> DataFrame:
    """Branches (domain, pos, address) against existing rows (domain, id, address), null addresses equal.

    Equal addresses pair up first, in order of position and id; then what is left over, in the same order; branches
    without a row are inserts, rows without a branch are stale. Both passes align ranks, so there is no loop.
    """
    by = lambda keys, order: F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    b = branches.withColumn("rank", by(["domain", "address"], "pos"))
    e = existing.withColumn("rank", by(["domain", "address"], "id"))
    same = b.alias("b").join(e.alias("e"), F.expr("b.domain = e.domain AND b.address <=> e.address AND b.rank = e.rank"), "full")
    same = same.select(F.coalesce("b.domain", "e.domain").alias("domain"), F.col("b.pos").alias("pos"), F.col("b.address").alias("address"), F.col("e.id").alias("id"))
    taken = same.where("pos IS NOT NULL AND id IS NOT NULL").withColumn("action", F.lit("keep"))
    free_b = same.where("id IS NULL").withColumn("rank", by(["domain"], "pos")).drop("id")
    free_e = same.where("pos IS NULL").withColumn("rank", by(["domain"], "id")).select("domain", "id", "rank")
    rest = free_b.join(free_e, ["domain", "rank"], "full").withColumn("action", F.when(F.col("pos").isNull(), "stale").when(F.col("id").isNull(), "insert").otherwise("reuse")).drop("rank")
    return taken.unionByName(rest)


def size_lanes(stores: DataFrame, products: DataFrame, threshold: int) -> DataFrame:
    """domain, products (of its largest website), lane."""
    counts = stores.join(products.select(F.col("store_id").alias("id"), "product_id"), "id", "left").groupBy("website").agg(F.count("product_id").alias("n"))
    return counts.groupBy(domain_key(F.col("website")).alias("domain")).agg(F.max("n").alias("products")).withColumn("lane", F.when(F.col("products") >= threshold, "large").otherwise("small"))


def geocode_pick(candidates: DataFrame, trusted: int = 2) -> DataFrame:
    """For each address of candidates (address, provider, found, ...) one that was found: without a zip in the address the
    first provider's; else the first provider's with a score of `trusted`, or where there is none the best score, the
    earlier on a tie."""
    rows = candidates.where("found IS NOT NULL")
    zip_, score = zip_code(F.col("address")), geocode_score(zip_code(F.col("address")), house_number(F.col("address")), F.col("found"))
    rows = rows.withColumn("_sure", zip_.isNull() | (score >= trusted)).withColumn("_score", F.when(F.col("_sure"), 0).otherwise(-score))
    return first_by(rows, ["address"], F.when(F.col("_sure"), 0).otherwise(1), F.col("_score"), F.col("provider"), *(F.col(c) for c in sorted(set(candidates.columns) - {"address", "provider", "found"}))).drop("_sure", "_score")
