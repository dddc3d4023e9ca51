"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

Terms are lower-cased words (what white space parts) with their counts as weights. For each of SAMPLES samples and each
term, hashes give r and c of Gamma(2, 1) and b of [0, 1); with t = floor(ln w / r + b) the term's value is
ln c - r * (t - b) - r, and the least value over a text's terms is kept. Two texts keep the same value with the
probability of their generalised Jaccard similarity, sum of least weights over sum of greatest.

A text and its edited text share all words before the cut, so their words are counted together: a term that weighs the
same in both is sampled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

#: Samples of a fingerprint, worked on so many at once: a row of a term then fits one compiled loop.
SAMPLES, AT_ONCE = 32, 8
#: Hexadecimal digits that a sample has in a fingerprint; 0 stands for a text without words.
DIGITS = 4


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, previous (its neighbour of the next greater doc_id, after the greatest the least), wants (floor(n / 3) of
    the longest text of `previous`), for each doc_id that is not null."""
    sizes = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n"), F.count("*").alias("rows"))
    sizes = cut(sizes, "sizes")
    # ranges of doc_ids with about as many of them each, whatever the ids are: one for each of the shuffle's partitions
    ranged = cut(sizes.repartitionByRange("doc_id").withColumn("range", F.spark_partition_id()), "ranged")
    firsts = ranged.groupBy("range").agg(F.min(F.struct("doc_id", "n")).alias("first"))
    after = firsts.select("range", F.lead("first").over(Window.orderBy("range")).alias("after"), F.min("first").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)).alias("least"))
    after = cut(after.select("range", F.coalesce("after", "least").alias("after")), "ranges")
    own = Window.partitionBy("range").orderBy("doc_id")
    ranged = ranged.withColumn("up", F.lead(F.struct("doc_id", "n")).over(own)).join(F.broadcast(after), "range")
    up = F.coalesce("up", "after")
    return ranged.select("doc_id", up["doc_id"].alias("previous"), F.floor(up["n"] / 3).cast("int").alias("wants"), "rows")


def _sample(term: Column, log_weight: Column, k: Column) -> Column:
    h, g, b = (F.xxhash64(term, k * 3 + j) for j in range(3))
    low = lambda x: (x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double") + 0.5) * F.lit(2.0**-32)
    high = lambda x: (F.shiftrightunsigned(x, 32).cast("double") + 0.5) * F.lit(2.0**-32)
    r = -F.ln(low(h) * high(h))
    beta = F.shiftrightunsigned(b, 11).cast("double") * F.lit(2.0**-53)
    step = r * (F.floor(log_weight / r + beta).cast("double") - beta + 1)
    return F.ln(-F.ln(low(g) * high(g))) - step


def _words(text: Column) -> Column:
    return F.split(F.lower(text), r"\s+")


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of docs
    (doc_id, text, ...).

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    document, in descending order of doc_id, after the last one the first. Null text: empty. Likeness is the share of
    equal samples; texts without words are like each other (1) and nothing else. Rows that repeat a doc_id have the
    same next document, and stand for it with the least of their texts. A row of a null doc_id is its own next one.
    Equal texts have equal fingerprints. Other columns are dropped. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = cut(neighbours(rows), "order")
    repeated = not order.where("rows > 1").isEmpty()
    known = rows.where("doc_id IS NOT NULL").join(order.drop("rows"), "doc_id")
    given = known.select(F.col("previous").alias("doc_id"), F.col("doc_id").alias("next_id"), F.expr("substring(text, 1, wants)").alias("given"), F.col("text").alias("least") if repeated else F.lit(1).alias("least"))
    if repeated:
        given = given.groupBy("doc_id", "next_id").agg(F.min_by("given", "least").alias("given"))
    both = known.select("doc_id", "text").join(given.select("doc_id", "next_id", "given"), "doc_id")
    lost = rows.where("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast("long").alias("next_id"), F.col("text").alias("given"))
    nameless = not docs.where("doc_id IS NULL").isEmpty()
    both = both.unionByName(lost) if nameless else both
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn("key", F.xxhash64("text"))
    both = both.withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
    both = both.withColumn("same", F.expr("substring(text, 1, CAST(n_chars AS INT) - cut)")).withColumn("edited", F.expr("concat(same, substring(given, 1, cut))"))
    info = both.select("doc_id", "key", "next_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))

    # a row that repeats must not count its words twice
    once = both.dropDuplicates(["doc_id", "key"]) if repeated or nameless else both
    # words before the last white space of the common part are in both texts
    whole = once.withColumn("shared", F.regexp_extract("same", r"(?s)^(.*\s)", 1))
    rest = lambda c: F.expr(f"substring({c}, length(shared) + 1)")
    kinds = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _words(t).alias("words")) for a, b, t in ((1, 1, F.col("shared")), (1, 0, rest("text")), (0, 1, rest("edited")))))
    parts = whole.select("doc_id", "key", F.inline(kinds)).select("doc_id", "key", "a", "b", F.explode("words").alias("word")).where("word <> ''")
    terms = parts.groupBy("doc_id", "key", F.xxhash64("word").alias("term")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    one = F.struct(F.col("a").alias("w"), F.lit(True).alias("in_a"), F.lit(True).alias("in_b"))
    two = F.array(F.struct(F.col("a").alias("w"), F.lit(True).alias("in_a"), F.lit(False).alias("in_b")), F.struct(F.col("b").alias("w"), F.lit(False).alias("in_a"), F.lit(True).alias("in_b")))
    weighed = terms.select("doc_id", "key", "term", F.inline(F.when(F.col("a") == F.col("b"), F.array(one)).otherwise(two))).where("w > 0")
    weighed = weighed.withColumn("log_w", F.ln(F.col("w").cast("double")))
    dealt = weighed.select("*", F.explode(F.array(*(F.lit(k) for k in range(0, samples, AT_ONCE)))).alias("first"))
    valued = dealt.select("doc_id", "key", "first", "in_a", "in_b", *(_sample(F.col("term"), F.col("log_w"), F.col("first") + j).alias(f"v{j}") for j in range(AT_ONCE)))
    least = valued.groupBy("doc_id", "key", "first").agg(*(F.min(F.when(F.col(f"in_{x}"), F.col(f"v{j}"))).alias(f"{x}{j}") for x in "ab" for j in range(AT_ONCE)))
    kept = lambda x: F.array(*(F.when(F.col(f"{x}{j}").isNull(), 0).otherwise(F.pmod(F.xxhash64(f"{x}{j}"), F.lit(16**DIGITS - 1)).cast("int") + 1) for j in range(AT_ONCE)))
    least = least.select("doc_id", "key", F.struct("first", kept("a").alias("a"), kept("b").alias("b")).alias("part"))
    whole = least.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    empty = F.array_repeat(F.lit(0), samples)
    prints = whole.select("doc_id", "key", F.flatten(F.col("parts.a")).alias("a"), F.flatten(F.col("parts.b")).alias("b"))
    of_row = info.alias("i").join(prints.alias("p"), F.expr("i.doc_id <=> p.doc_id AND i.key = p.key"), "left")
    of_row = cut(of_row.select("i.doc_id", "next_id", "n_chars", "edited_sha256", F.coalesce("a", empty).alias("a"), F.coalesce("b", empty).alias("b"), "i.key"), "prints")
    of_next = of_row.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("next_id"), F.col("a").alias("next_a"), "key")
    if repeated:
        of_next = _of_least_text(rows, of_next)
    like = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.when(p == q, 1.0).otherwise(0.0)), F.lit(0.0), lambda s, z: s + z) / samples
    text_of = lambda x: F.array_join(F.transform(x, lambda v: F.lpad(F.lower(F.hex(v)), DIGITS, "0")), "")
    done = of_row.join(of_next.drop("key"), "next_id", "left")
    return done.select(
        "doc_id", "n_chars", "edited_sha256", text_of("a").alias("fingerprint"), text_of("b").alias("edited_fingerprint"),
        like("a", "b").alias("near_edited"), like("a", F.coalesce("next_a", "a")).alias("near_next"),
    )


def _of_least_text(rows: DataFrame, prints: DataFrame) -> DataFrame:
    """One print for each doc_id: that of the least of its texts."""
    least = rows.groupBy("doc_id").agg(F.xxhash64(F.min("text")).alias("key")).withColumnRenamed("doc_id", "next_id")
    return prints.join(least, ["next_id", "key"], "left_semi").dropDuplicates(["next_id"])
