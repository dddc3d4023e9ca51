"""Image verdicts and scores: keep rules, thresholds, distributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import budget_chunks  # noqa: F401 (its place in earlier versions)
from .rules import verdict_class

#: Ranges of values that ranks are counted in; a power of two.
RANGES = 256


def lead_image_rule(verdicts: DataFrame, keys: list[str], lead: int = 5) -> DataFrame:
    """keys, keep, reason, best_prob of verdicts (keys, i, code, prob) of each product's first images.

    A pass keeps; else a transient code keeps, with the last such reason; else it goes, with the last drop reason and
    the best probability.
    """
    v = verdicts.where(F.col("i") < lead).withColumn("kind", verdict_class(F.col("code")))
    last = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct("i", "code")))["code"]
    rows = v.groupBy(*keys).agg(F.max((F.col("kind") == "pass").cast("int")).alias("passed"), last("transient").alias("waits"), last("drop").alias("fails"), F.max("prob").alias("best"))
    keep = (F.col("passed") == 1) | F.col("waits").isNotNull()
    return rows.select(*keys, keep.alias("keep"), F.when(F.col("passed") == 0, F.coalesce("waits", "fails")).alias("reason"), F.when(~keep, F.col("best")).alias("best_prob"))


def gallery_rule(products: DataFrame, verdicts: DataFrame, keys: list[str], cap: int, also: tuple[str, ...] = ()) -> DataFrame:
    """keys, images, kept (and other columns, as they are) of products (keys, images): passing images among the first `cap` and the untested rest; all,
    if none passes and no verdict drops; null and gone, if none passes and one does."""
    v = verdicts.where(F.col("i") < cap).withColumn("kind", verdict_class(F.col("code")))
    sums = v.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("kind") == "pass", F.col("i")))).alias("good"), F.max((F.col("kind") == "drop").cast("int")).alias("drops"))
    rows = products.join(sums, keys, "left")
    some = F.size(F.coalesce("good", F.array().cast("array<int>"))) > 0
    trimmed = F.filter(F.col("images"), lambda x, i: (i >= cap) | F.array_contains(F.col("good"), i))
    images = F.when(some, trimmed).when(F.coalesce("drops", F.lit(1)) == 0, F.col("images"))
    return rows.select(*keys, images.alias("images"), images.isNotNull().alias("kept"), *also)


def verdict_join(products: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, verdicts: for each image of products (keys, images), in order, its url and what verdicts (url, code, prob) say
    of it (null: none). A product without images has an empty list."""
    each = products.select(*keys, F.posexplode_outer("images").alias("pos", "url"))
    said = each.join(verdicts.select("url", "code", "prob", F.lit(True).alias("judged")), "url", "left")
    row = F.when(F.col("pos").isNotNull(), F.struct("pos", "url", F.coalesce("judged", F.lit(False)).alias("judged"), "code", "prob"))
    return said.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("verdicts"))


def product_score(images: DataFrame, prompts: DataFrame, scale: float = 100.0) -> DataFrame:
    """vec_id, best_positive, best_negative (labels), score of images (vec_id, embedding) against prompts (label,
    embedding, positive), a handful, which every row gets as one array. score is 1 / (1 + exp(scale * (negative - positive
    cosine))). Images are scored in their row, without a shuffle."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, z: s + z)
    norm = lambda a: F.sqrt(dot(a, a))
    known = prompts.select(F.struct("label", "positive", "embedding", norm(F.col("embedding")).alias("norm")).alias("p")).agg(F.collect_list("p").alias("prompts"))
    rows = images.select("vec_id", "embedding", norm(F.col("embedding")).alias("norm")).crossJoin(F.broadcast(known))  # one row
    cosine = lambda p: F.round(dot(F.col("embedding"), p["embedding"]) / (F.col("norm") * p["norm"]), 9)
    rows = rows.select("vec_id", F.transform("prompts", lambda p: F.struct(p["positive"].alias("positive"), cosine(p).alias("cosine"), p["label"].alias("label"))).alias("all"))
    best = lambda sign: F.array_max(F.transform(F.filter("all", lambda x: x["positive"] == sign), lambda x: F.struct(x["cosine"].alias("cosine"), x["label"].alias("label"))))
    rows = rows.select("vec_id", best(True).alias("p"), best(False).alias("n"))
    return rows.select("vec_id", F.col("p.label").alias("best_positive"), F.col("n.label").alias("best_negative"), F.round(1 / (1 + F.exp(scale * (F.col("n.cosine") - F.col("p.cosine")))), 6).alias("score"))


def ranked_counts(rows: DataFrame, value: str, *keys: str) -> DataFrame:
    """keys, value, before, upto, n: of each different value how many rows come before it, up to it, and in all. Nulls and
    NaN are left out; infinities are values as any.

    Values are counted first; counts are summed by ranges of values, so that neither one key nor one sort takes all. The
    ranges hold about equally many different values, by a quantile sketch that is merged over tasks.
    """
    number = F.col(value).cast("double")
    counts = rows.where(F.col(value).isNotNull() & ~F.isnan(number)).groupBy(*keys, value).agg(F.count("*").alias("k"))
    cuts = [k / RANGES for k in range(1, RANGES)]
    ends = counts.groupBy(*keys).agg(F.percentile_approx(number, cuts, 16 * RANGES).alias("_cuts"))
    counts = counts.join(ends, list(keys)) if keys else counts.crossJoin(ends)  # one row
    # the number of cuts below the value, found by halving
    below = lambda at, step: F.when((at + step <= F.size("_cuts")) & (F.get("_cuts", at + step - 1) < number), at + step).otherwise(at)
    steps = F.array(*(F.lit(RANGES >> k) for k in range(1, RANGES.bit_length())))
    counts = counts.withColumn("_range", F.aggregate(steps, F.lit(0), below)).drop("_cuts")
    sums = counts.groupBy(*keys, "_range").agg(F.sum("k").alias("_k"))
    own = Window.partitionBy(*keys).orderBy("_range")  # RANGES ranges of a key at most
    sums = sums.select(*keys, "_range", (F.sum("_k").over(own) - F.col("_k")).alias("_base"), F.sum("_k").over(Window.partitionBy(*keys)).alias("n"))
    inside = Window.partitionBy(*keys, "_range").orderBy(value)
    rows = counts.join(sums, [*keys, "_range"]).withColumn("upto", F.col("_base") + F.sum("k").over(inside))
    return rows.select(*keys, value, (F.col("upto") - F.col("k")).alias("before"), "upto", "n", "k")


def distribution(scores: DataFrame, column: str) -> DataFrame:
    """n, least, p10, p25, median, mean, p75, p90, most: exact percentiles, linear between ranks, read off the ranks of
    counted values.

    Nulls and NaN are left out of all of them. Infinities count: a percentile between an infinite value and another is the
    infinite one (between both, NaN), and the mean is infinite (with both, NaN).
    """
    ranked = ranked_counts(scores, column)
    names = {"p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9}
    at = lambda place: F.max(F.when((F.col("before") <= place) & (place < F.col("upto")), F.col(column)))
    spot = {name: F.lit(q) * (F.col("n") - 1) for name, q in names.items()}
    low = [at(F.floor(x)).alias(f"{name}_low") for name, x in spot.items()]
    high = [at(F.ceil(x)).alias(f"{name}_high") for name, x in spot.items()]
    sums = ranked.agg(F.max("n").alias("n"), F.min(column).alias("least"), F.max(column).alias("most"), (F.sum(F.col(column) * F.col("k")) / F.max("n")).alias("mean"), *low, *high)
    part = {name: x - F.floor(x) for name, x in spot.items()}

    def between(name: str) -> Column:
        a, b = F.col(f"{name}_low"), F.col(f"{name}_high")
        endless = lambda x: F.abs(x.cast("double")) == float("inf")
        value = F.when(a == b, a).when(endless(a) & endless(b), float("nan")).when(endless(a), a).when(endless(b), b).otherwise(F.round(a + (b - a) * part[name], 6))
        return value.alias(name)

    finite = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.round(c, 6)).otherwise(F.col(c)).alias(c)
    return sums.select(F.coalesce("n", F.lit(0)).alias("n"), "least", between("p10"), between("p25"), between("median"), finite("mean"), between("p75"), between("p90"), "most")


def drop_stats(verdicts: DataFrame, key: str, value: str) -> DataFrame:
    """key, n, least, median (the upper one), most of a value; nulls and NaN are left out."""
    ranked = ranked_counts(verdicts.where(F.col(key).isNotNull()), value, key)
    middle = F.min(F.when(F.col("upto") > F.floor(F.col("n") / 2), F.col(value)))
    return ranked.groupBy(key, "n").agg(F.min(value).alias("least"), middle.alias("median"), F.max(value).alias("most"))


def threshold_sweep(scores: DataFrame, thresholds: list[float], score: str, label: str) -> DataFrame:
    """threshold, tp, fn, fp, precision (1 where nothing is kept), recall, f1, best: the first of greatest f1. Rows are
    read once: each adds to the sums of all thresholds, a fixed and small number."""
    names = list(range(len(thresholds)))
    sums = scores.agg(F.count_if(F.col(label)).alias("pos"), *(F.count_if(F.col(label) & (F.col(score) >= thresholds[k])).alias(f"tp{k}") for k in names), *(F.count_if(~F.col(label) & (F.col(score) >= thresholds[k])).alias(f"fp{k}") for k in names))
    each = F.array(*(F.struct(F.lit(thresholds[k]).alias("threshold"), F.col(f"tp{k}").alias("tp"), F.col(f"fp{k}").alias("fp")) for k in names))
    rows = sums.select("pos", F.inline(each)).withColumn("fn", F.col("pos") - F.col("tp"))
    precision = F.when(F.col("tp") + F.col("fp") == 0, 1.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fp")))
    recall = F.when(F.col("pos") == 0, 0.0).otherwise(F.col("tp") / F.col("pos"))
    rows = rows.withColumn("precision", precision).withColumn("recall", recall)
    rows = rows.withColumn("f1", F.round(F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0), 6))
    first = Window.orderBy(F.desc("f1"), "threshold")  # a row for each threshold
    return rows.select("threshold", "tp", "fn", "fp", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), "f1", (F.row_number().over(first) == 1).alias("best"))


def retry_resolution(urls: DataFrame, attempts: DataFrame) -> DataFrame:
    """url, passed, reason of urls and attempts (url, attempt, passed, reason): a pass clears failures, else the last
    attempt's reason holds; no attempt: chunk_timeout."""
    last = attempts.groupBy("url").agg(F.max("passed").alias("passed"), F.max(F.struct("attempt", "reason"))["reason"].alias("reason"))
    rows = urls.join(last, "url", "left")
    passed = F.coalesce("passed", F.lit(False))
    return rows.select("url", passed.alias("passed"), F.when(~passed, F.coalesce("reason", F.lit("chunk_timeout"))).alias("reason"))
