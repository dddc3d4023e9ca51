"""Next table state from the current one and what came in: one full outer join and a policy for each column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Shares of the production catalog that a scrape must match before absences count.
COMPLETE_FLOOR, PARTIAL_FLOOR = 0.1, 0.5
END_STATUSES = (400, 404, 410)


def merge_frames(current: DataFrame, incoming: DataFrame, keys: list[str], policy: dict[str, str], inserts: bool = True, null_safe: tuple[str, ...] = ()) -> DataFrame:
    """The next state of `current`, with its columns.

    policy gives a column's rule: overwrite (incoming wins on matched rows), coalesce (incoming, if it is not null),
    keep (current wins, inserts take the incoming). Columns that are not named are kept. `inserts`: add unmatched
    incoming rows. Keys in null_safe match on null. Applying the same incoming rows twice changes nothing.
    """
    c, i = current.alias("c"), incoming.alias("i")
    on = None
    for k in keys:
        one = F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}")) if k in null_safe else F.col(f"c.{k}") == F.col(f"i.{k}")
        on = one if on is None else on & one
    joined = c.withColumn("_c", F.lit(True)).alias("c").join(i.withColumn("_i", F.lit(True)).alias("i"), on, "full" if inserts else "left")

    def value(name: str) -> Column:
        if name in keys:
            return F.when(F.col("c._c").isNotNull(), F.col(f"c.{name}")).otherwise(F.col(f"i.{name}")).alias(name)
        if name not in incoming.columns:
            return F.col(f"c.{name}").alias(name)
        rule = policy.get(name, "keep")
        new, old = F.col(f"i.{name}"), F.col(f"c.{name}")
        if rule == "overwrite":
            return F.when(F.col("i._i").isNotNull(), new).otherwise(old).alias(name)
        if rule == "coalesce":
            return F.coalesce(new, old).alias(name)
        return F.when(F.col("c._c").isNotNull(), old).otherwise(new).alias(name)

    return joined.select(*(value(n) for n in current.columns))


def last_of(incoming: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Of rows with the same key the last one."""
    at = Window.partitionBy(*keys).orderBy(F.desc(ordinal))
    return incoming.withColumn("_rank", F.row_number().over(at)).where("_rank = 1").drop("_rank")


def upsert_products(current: DataFrame, incoming: DataFrame, ordinal: str = "ord") -> DataFrame:
    """Everything is overwritten but gender label and probabilities, which a null does not clear; the last of
    duplicates wins."""
    overwrite = {n: "overwrite" for n in current.columns} | {"gender_label": "coalesce", "gender_probs": "coalesce", "first_seen": "keep"}
    return merge_frames(current, last_of(incoming, ["store_id", "product_id"], ordinal).drop(ordinal), ["store_id", "product_id"], overwrite)


def numbered(rows: DataFrame, start: DataFrame, name: str, spread: Column, *order: Column) -> DataFrame:
    """rows with `name`: numbers behind the one value of start (a row and column), in order of the first three hex digits
    of spread's md5, then `order`. Numbers come from counts of these 4,096 ranges, so no task sorts all rows."""
    rows = rows.withColumn("_range", F.substring(F.md5(spread), 1, 3))
    counts = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    base = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_base")).crossJoin(start.toDF("_start"))
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return ranked.join(base, "_range").withColumn(name, F.coalesce("_start", F.lit(0)) + F.col("_base") + F.col("_k")).drop("_range", "_k", "_base", "_start")


def upsert_store(current: DataFrame, incoming: DataFrame, seen_at: Column | None = None, ordinal: str | None = None) -> DataFrame:
    """By domain and address (null equals null), the row of least id; inserts get ids behind the greatest. Of incoming rows
    of one domain and address the last by ordinal counts (by the row's own columns, where none is named), so no id
    comes twice and no key gets two.

    Name, type, raw and website are overwritten; handle, lat, long, policy and policy_url only by what is not null. With
    seen_at, every row that came in is `scraped` and has it as last_seen. Columns that current lacks are dropped.
    """
    rules = dict.fromkeys(("store_name", "store_type", "raw", "website"), "overwrite") | dict.fromkeys(("handle", "lat", "long", "policy", "policy_url"), "coalesce")
    last = F.col(ordinal) if ordinal else F.to_json(F.struct(*incoming.columns))
    incoming = last_of(incoming.withColumn("_last", last), ["domain", "address"], "_last").drop("_last", *([ordinal] if ordinal else []))
    if seen_at is not None:
        incoming = incoming.withColumn("scraped", F.lit(True)).withColumn("last_seen", seen_at)
        rules |= {"scraped": "overwrite", "last_seen": "overwrite"}
    first = Window.partitionBy("domain", "address").orderBy("id")
    ranked = current.withColumn("_rank", F.row_number().over(first))
    merged = merge_frames(ranked.where("_rank = 1").drop("_rank"), incoming, ["domain", "address"], rules, null_safe=("address",))
    new = numbered(merged.where("id IS NULL").drop("id"), current.agg(F.max("id")), "id", F.col("domain"), F.col("domain"), F.col("address"))
    return merged.where("id IS NOT NULL").unionByName(new).unionByName(ranked.where("_rank > 1").drop("_rank"))


def catalog_diff(production: DataFrame, scraped: DataFrame, keys: list[str], repeats: bool = False) -> DataFrame:
    """keys and kind (matched, missing, new), from one full outer join of distinct keys; with repeats, of the rows as they are,
    so that a key comes as often as rows of both sides meet."""
    once = lambda rows: rows.select(*keys) if repeats else rows.select(*keys).distinct()
    p, s = once(production).withColumn("_p", F.lit(1)), once(scraped).withColumn("_s", F.lit(1))
    kind = F.when(F.col("_s").isNull(), "missing").when(F.col("_p").isNull(), "new").otherwise("matched")
    return p.join(s, keys, "full").select(*keys, kind.alias("kind"))


def range_digests(rows: DataFrame, domain: str, key: str, ranges: int) -> DataFrame:
    """domain, range, digest of rows: count and order-free sums of 128 bits of hashes of the keys in each of `ranges` ranges of
    a domain's keys. They are summed before the shuffle, so a domain of any size is `ranges` rows."""
    place = F.pmod(F.xxhash64(F.lit("range"), key), F.lit(ranges)).cast("int")
    halves = [h for seed in ("a", "b") for x in [F.xxhash64(F.lit(seed), key)] for h in (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return rows.groupBy(domain, place.alias("range")).agg(F.struct(F.count("*").alias("n"), *(F.sum(h).alias(f"h{i}") for i, h in enumerate(halves))).alias("digest"))


def changed_ranges(production: DataFrame, scraped: DataFrame, domain: str, key: str, ranges: int) -> DataFrame:
    """domain, range of the ranges whose keys are not the same, or not as often there, on both sides."""
    p, s = (range_digests(x, domain, key, ranges).withColumnRenamed("digest", name) for x, name in ((production, "_p"), (scraped, "_s")))
    return p.join(s, [domain, "range"], "full").where(~F.col("_p").eqNullSafe(F.col("_s"))).select(domain, "range")


def digest_diff(production: DataFrame, scraped: DataFrame, keys: list[str], ranges: int = 64, unique: bool = False, repeats: bool = False) -> DataFrame:
    """catalog_diff of keys [domain, key] that hold no null, but only ranges whose digests differ are joined: the rest is matched, and is
    read off production as it stands. Where a re-scrape changes little, little is shuffled.

    Equal digests mean equal keys but for a chance of about 2**-128 a range. With unique, keys do not repeat within
    production, and what is matched is not shuffled at all; else it is made distinct, or with repeats counted, as a key that
    both sides have n times comes n * n times. A list of changed ranges is as long as there
    are changes; rows find it by a join that Spark broadcasts where it is small.
    """
    domain, key = keys
    place = F.pmod(F.xxhash64(F.lit("range"), key), F.lit(ranges)).cast("int").alias("range")
    changed = changed_ranges(production, scraped, domain, key, ranges)
    p, s = production.select(*keys, place), scraped.select(*keys, place)
    both = [domain, "range"]
    same = p.join(changed, both, "left_anti").select(*keys, F.lit("matched").alias("kind"))
    if not unique:
        same = same.groupBy(*keys, "kind").agg(F.count("*").alias("_n")).select(*keys, "kind", F.explode(F.sequence(F.lit(1), F.col("_n") * F.col("_n")))).drop("col") if repeats else same.distinct()
    return catalog_diff(p.join(changed, both, "left_semi"), s.join(changed, both, "left_semi"), keys, repeats).unionByName(same)


def removal_plan(diff: DataFrame, state: DataFrame, domain: str, complete_floor: float = COMPLETE_FLOOR, partial_floor: float = PARTIAL_FLOOR) -> DataFrame:
    """domain, production, matched, missing, added, reason: what to do about missing products of a domain.

    state: domain, complete. Reasons, the first that holds: nothing missing, empty scrape, low coverage (below the
    floor of a complete or partial scrape), flag.
    """
    n = lambda kind: F.count_if(F.col("kind") == kind)
    sums = diff.groupBy(domain).agg(n("matched").alias("matched"), n("missing").alias("missing"), n("new").alias("added"))
    sums = sums.join(state, domain, "left").withColumn("production", F.col("matched") + F.col("missing"))
    floor = F.when(F.coalesce("complete", F.lit(False)), complete_floor).otherwise(partial_floor)
    reason = (
        F.when(F.col("missing") == 0, "nothing missing").when(F.col("matched") + F.col("added") == 0, "empty scrape")
        .when(F.col("matched") < floor * F.col("production"), "low coverage").otherwise("flag")
    )
    return sums.select(domain, "production", "matched", "missing", "added", reason.alias("reason"))


def mark_removed(products: DataFrame, diff: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """products with unavailable set where the plan flags their domain and they are missing; nothing else changes."""
    domain = keys[0]
    gone = diff.where("kind = 'missing'").join(plan.where("reason = 'flag'").select(domain), domain, "left_semi").select(*keys).withColumn("_gone", F.lit(True))
    return products.join(gone, keys, "left").withColumn("newly_unavailable", F.coalesce("_gone", F.lit(False)) & ~F.col("unavailable")).withColumn("unavailable", F.col("unavailable") | F.coalesce("_gone", F.lit(False))).drop("_gone")


def refresh_metadata(products: DataFrame, scraped: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Named columns of matched rows overwritten; images, labels and unmatched rows as they were; nothing inserted."""
    return merge_frames(products, scraped.select(*keys, *columns), keys, {c: "overwrite" for c in columns}, inserts=False)


def stops(pages: DataFrame, streaming: bool = False) -> DataFrame:
    """domain, first (page, stop: the earliest page that ends the walk, and why), last (page): what completeness is told
    from. Least firsts and greatest lasts of parts of the pages are those of all."""
    error = F.col("http_status") >= 400
    gone = F.col("http_status").isin(*END_STATUSES) & F.lit(streaming)
    stop = (
        F.when(error & (F.col("page") == 1), "failed").when(error & gone, "end of catalog").when(error, "error").when(F.col("n_products").isNull(), "missing key")
        .when(F.col("n_products") == 0, "empty").when((F.col("n_new") == 0) & ~F.lit(streaming), "repeated page")
    )
    return pages.withColumn("stop", stop).groupBy("domain").agg(F.min(F.when(F.col("stop").isNotNull(), F.struct("page", "stop"))).alias("first"), F.max("page").alias("last"))


def verdicts_of_stops(ends: DataFrame, cap: int = 100) -> DataFrame:
    reason = F.coalesce(F.col("first.stop"), F.when(F.col("last") >= cap, "cap").otherwise("budget"))
    return ends.select("domain", F.coalesce("first.page", "last").alias("end_page"), reason.alias("reason"), reason.isin("empty", "repeated page", "end of catalog").alias("complete"))


def completeness(pages: DataFrame, cap: int = 100, streaming: bool = False) -> DataFrame:
    """domain, end_page, reason, complete of landed pages (domain, page, http_status, n_products: null if the key is
    missing, n_new).

    The earliest page that ends the walk decides: failed (an error on page 1), error (later; with streaming 400, 404
    and 410 there end the catalog), missing key, empty, repeated page (not with streaming), else the cap or the budget.
    """
    return verdicts_of_stops(stops(pages, streaming), cap)


def mark_status(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """Run rows (run_id, website, status, attempts, error) after status updates (run_id, website, status, error).

    An unseen row starts with one attempt; attempts grow only on leaving pending, and are one at least; an error is
    kept when the new one is null, and cut to 2000 characters.
    """
    r, u = runs.alias("r"), updates.alias("u")
    at = F.expr("r.run_id = u.run_id AND r.website = u.website")
    j = r.join(u, at, "full")
    hit = F.col("u.website").isNotNull()
    grown = F.col("r.attempts") + F.when((F.col("r.status") == "pending") & (F.col("u.status") != "pending"), 1).otherwise(0)
    attempts = F.when(F.col("r.website").isNull(), 1).when(hit, F.greatest(grown, F.lit(1))).otherwise(F.col("r.attempts"))
    return j.select(
        F.coalesce("r.run_id", "u.run_id").alias("run_id"), F.coalesce("r.website", "u.website").alias("website"), F.coalesce("u.status", "r.status").alias("status"),
        attempts.cast("int").alias("attempts"), F.left(F.coalesce("u.error", "r.error"), F.lit(2000)).alias("error"),
    )


def prune(rows: DataFrame, keep: DataFrame, domain: str, most: int = 25) -> DataFrame:
    """Rows and whether they go: their domain is not kept. Nothing goes if nothing is kept, or more than `most` domains
    would."""
    doomed = rows.select(domain).distinct().join(keep.select(domain).distinct(), domain, "left_anti")
    guard = doomed.agg(F.count("*").alias("_doomed")).withColumn("_one", F.lit(1)).join(keep.agg(F.count("*").alias("_kept")).withColumn("_one", F.lit(1)), "_one")
    marked = rows.join(doomed.withColumn("_gone", F.lit(True)), domain, "left").withColumn("_one", F.lit(1)).join(F.broadcast(guard), "_one")
    return marked.withColumn("pruned", F.coalesce("_gone", F.lit(False)) & (F.col("_kept") > 0) & (F.col("_doomed") <= most)).drop("_gone", "_one", "_doomed", "_kept")


def constraint_errors(rows: DataFrame, checks: dict[str, Column], unique: list[str]) -> DataFrame:
    """rows with `errors`: names of the checks that a row fails, and `unique` where its key repeats (keys with a null
    count as equal). Valid rows have none; the rest are to be quarantined."""
    counts = rows.groupBy(*unique).agg(F.count("*").alias("_n"))
    on = None
    for k in unique:
        one = F.col(f"r.{k}").eqNullSafe(F.col(f"n.{k}"))
        on = one if on is None else on & one
    both = rows.alias("r").join(counts.alias("n"), on).select("r.*", "_n")
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()] + [F.when(F.col("_n") > 1, F.lit("unique"))]
    return both.withColumn("errors", F.array_compact(F.array(*failed))).drop("_n")


def conform(rows: DataFrame, schema: dict[str, tuple[str, object]]) -> DataFrame:
    """rows in a declared order of columns: missing ones get their default, others are cast; unknown ones go."""
    return rows.select(*(F.col(n).try_cast(kind).alias(n) if n in rows.columns else F.lit(default).cast(kind).alias(n) for n, (kind, default) in schema.items()))
