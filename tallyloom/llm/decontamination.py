"""Benchmark decontamination by a distributed positional inverted index.

The texts' words are stored in blocks of bounded length, and the index as postings: (hash of term, row, position), for
the terms that the tests ask for. A test is a window of words. Its lists are intersected from its rarest term on, by how
often terms occur in all documents: each posting of the rarest, moved back by the term's place in the window, is a start
that the window may have; it stays if the list of the next rarest term, moved back likewise, has it too (exact phrase),
or has one within a few words (proximity). What stays is compared with the stored words. Only DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

#: A word: digits, ASCII letters and whatever is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
#: Words that a block has of its own, and those it repeats of its neighbours on either side.
BLOCK, MARGIN = 256, 32
#: Tables of tests of up to so many rows and bytes are sent to every task; larger ones are joined by shuffles.
SMALL_ROWS, SMALL_BYTES = 500_000, 16_000_000


def words(text: Column) -> Column:
    """The text's words with A-Z lower-cased. Null has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII: the plain lower is enough, and quicker
    return F.regexp_extract_all(F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), F.lit(WORD), F.lit(0))


def _small(df: DataFrame, rows: int, size: int = 0) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL_ROWS and size <= SMALL_BYTES else df


def blocks(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, block, before, words for every row of docs, written: the documents' words in blocks. A block has
    BLOCK words of its own and up to MARGIN (before: how many on the left) of each neighbour; a row without words has
    one empty block. row tells rows apart whose doc_id repeats or is null."""
    slim = docs.select(F.col("doc_id").cast("long"), words(F.col("text")).alias("all")).withColumn("row", F.monotonically_increasing_id())
    slim = slim.withColumn("n_words", F.size("all").cast("long"))
    last = F.greatest(F.ceil(F.col("n_words") / BLOCK) - 1, F.lit(0)).cast("int")
    each = slim.withColumn("block", F.explode(F.sequence(F.lit(0), last)))
    before = F.when(F.col("block") > 0, MARGIN).otherwise(0)
    own = F.slice("all", F.col("block") * BLOCK - before + 1, before + BLOCK + MARGIN)
    return cut(each.select("row", "doc_id", "n_words", "block", before.alias("before"), own.alias("words")), "blocks")


def _own(stored: DataFrame) -> DataFrame:
    """Hash, row and position of each word."""
    one = stored.select("row", "block", F.posexplode(F.transform(F.slice("words", F.col("before") + 1, BLOCK), lambda w: F.xxhash64(w))).alias("at", "h"))
    return one.select("h", "row", (F.col("block") * BLOCK + F.col("at")).alias("pos"))


def windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window, test: their words) and the windows of items (window, item_id), written. Windows are
    all runs of size words of an item; an item of fewer words, but not none, is one window."""
    items = benchmark.select(F.col("item_id").cast("string"), words(F.col("text")).alias("all")).where(F.size("all") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - size + 1, F.lit(1))))
    each = cut(items.withColumn("start", start).select("item_id", F.slice("all", F.col("start"), size).alias("test")).distinct(), "tests")
    distinct = cut(each.select("test").distinct().withColumn("window", F.monotonically_increasing_id()), "windows")
    return distinct, cut(each.join(distinct, "test").select("window", "item_id").distinct(), "items")


def _probes(stored: DataFrame, tests: DataFrame, n_tests: int) -> DataFrame:
    """window, size, h1, at1, h2, at2: each window's rarest term and the next rarest with their places in it, by counts
    over all documents. A window of one word has it twice."""
    terms = tests.select("window", F.posexplode(F.transform("test", lambda w: F.xxhash64(w))).alias("at", "h"))
    asked = terms.select("h").distinct()
    counts = cut(_own(stored).join(_small(asked, n_tests * WINDOW), "h", "left_semi").groupBy("h").agg(F.count("*").alias("n")), "counts")
    rarity = terms.join(counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    both = rarity.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("n", "at", "h"))).alias("by"))  # WINDOW entries at most
    first, second = F.element_at("by", 1), F.when(F.size("by") > 1, F.element_at("by", 2)).otherwise(F.element_at("by", 1))
    probes = both.select("window", F.size("by").alias("size"), first.alias("a"), second.alias("b")).where("a.n > 0 AND b.n > 0")
    return cut(probes.select("window", "size", F.col("a.h").alias("h1"), F.col("a.at").alias("at1"), F.col("b.h").alias("h2"), F.col("b.at").alias("at2")), "probes")


def _postings(stored: DataFrame, probes: DataFrame, n_tests: int) -> DataFrame:
    asked = probes.select(F.explode(F.array("h1", "h2")).alias("h")).distinct()
    return cut(_own(stored).join(_small(asked, 2 * n_tests), "h", "left_semi").sortWithinPartitions("h"), "postings")


def _measure(tests: DataFrame) -> tuple[int, int]:
    n, size = tests.agg(F.count("*"), F.sum(F.octet_length(F.array_join("test", " ")))).first()
    return n, size or 0


def phrase_matches(stored: DataFrame, tests: DataFrame) -> DataFrame:
    """row, window, start, size: every place of the documents (blocks) at which a test (windows) occurs word for word."""
    n_tests, size = _measure(tests)
    probes = _probes(stored, tests, n_tests)
    postings = _postings(stored, probes, n_tests)
    first = postings.withColumnRenamed("h", "h1").join(_small(probes, n_tests), "h1")
    first = first.select("row", "window", "size", (F.col("pos") - F.col("at1")).alias("start"), F.col("h2").alias("h"), (F.col("pos") - F.col("at1") + F.col("at2")).alias("pos"))
    both = first.where("start >= 0").join(postings, ["row", "pos", "h"]).select("row", "window", "size", "start")
    found = cut(both.withColumn("block", F.floor(F.col("start") / BLOCK).cast("int")), "found")
    return _compared(found, stored, tests, n_tests, size).select("row", "window", "start", "size")


def _held(found: DataFrame, stored: DataFrame) -> DataFrame:
    """The blocks that found names."""
    needed = cut(found.select("row", "block").distinct(), "needed")
    return stored.select("row", "block", "before", "words").join(_small(needed, needed.count()), ["row", "block"], "left_semi")


def _compared(found: DataFrame, stored: DataFrame, tests: DataFrame, n_tests: int, size: int) -> DataFrame:
    at = F.col("start") - F.col("block") * BLOCK + F.col("before") + 1
    rows = found.join(_held(found, stored), ["row", "block"]).join(_small(tests, n_tests, size), "window")
    return rows.where(F.slice("words", at, F.col("size")) == F.col("test"))


def proximity_matches(stored: DataFrame, tests: DataFrame, slack: int = 4, least: float = 0.8) -> DataFrame:
    """row, window, start, size, shared: places near which a test occurs with words added, left out or changed. There its
    two rarest terms stand as far apart as in the test, but for slack words, and of the test's distinct terms (size) at
    least the share least (shared: how many) lies between slack words before where the rarest says it starts and slack
    words behind where it ends. Exact phrases are among them. slack is MARGIN - WINDOW at most."""
    if not 0 <= slack <= MARGIN - WINDOW:
        raise ValueError(f"slack is 0 to {MARGIN - WINDOW}")
    n_tests, size = _measure(tests)
    probes = _probes(stored, tests, n_tests)
    postings = _postings(stored, probes, n_tests)
    # lists meet in cells of slack + 1 positions: what is within slack lies in the same cell or the next
    cell = lambda x: F.floor(x / (slack + 1)).cast("long")
    first = postings.withColumnRenamed("h", "h1").join(_small(probes, n_tests), "h1")
    first = first.select("row", "window", "size", (F.col("pos") - F.col("at1")).alias("start"), "at2", F.col("h2").alias("h")).withColumn("due", F.col("start") + F.col("at2"))
    first = first.withColumn("cell", F.explode(F.array(cell(F.col("due")) - 1, cell(F.col("due")), cell(F.col("due")) + 1)))
    both = first.join(postings.withColumn("cell", cell(F.col("pos"))), ["row", "cell", "h"]).where(F.abs(F.col("pos") - F.col("due")) <= slack)
    found = both.select("row", "window", "size", "start", F.floor(F.greatest("start", F.lit(0)) / BLOCK).cast("int").alias("block")).distinct()
    found = cut(found, "near")
    # the span may begin before the block's words and end behind those of the text
    left = F.col("start") - slack - F.col("block") * BLOCK + F.col("before")
    span = F.slice("words", F.greatest(left, F.lit(0)).cast("int") + 1, F.greatest(F.col("size") + 2 * slack + F.least(left, F.lit(0)), F.lit(0)).cast("int"))
    rows = found.join(_held(found, stored), ["row", "block"]).join(_small(tests, n_tests, size), "window")
    rows = rows.select("row", "window", "start", F.size(F.array_distinct("test")).alias("size"), F.size(F.array_intersect("test", span)).alias("shared"))
    return rows.where(F.col("shared") >= F.ceil(F.col("size") * least))


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs (doc_id, text, ...).

    A word is hit if it lies in any occurrence of a window of any item of benchmark (item_id, text, ...); n_items counts
    items with an occurring window. Null texts have no words; items without words have no window; items of a null
    item_id hit words but are not counted; items that repeat an item_id count once. Rows stand for themselves. Other
    columns are dropped. No rows give no rows; an empty benchmark hits nothing.

    Work of one row's matches is sorted by itself (a row's own matches, at most its words times the windows that hold
    its rarest terms); no test, term or doc_id is a group.
    """
    stored = blocks(docs)
    tests, items = windows(benchmark, size)
    hits = cut(phrase_matches(stored, tests), "hits")
    # words in the union of the spans: each start counts what reaches beyond all spans before it
    spans = hits.groupBy("row", "start").agg(F.max(F.col("start") + F.col("size")).alias("end"))
    reached = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    hit = spans.withColumn("reached", F.coalesce(reached, F.lit(0))).groupBy("row").agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "reached"), F.lit(0))).cast("long").alias("n_hit"))
    named = hits.select("row", "window").distinct().join(items, "window").select("row", "item_id").where("item_id IS NOT NULL").distinct()
    # a row's items: no more than there are items
    listed = named.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    rows = stored.where("block = 0").select("row", "doc_id", "n_words").join(hit, "row", "left").join(listed, "row", "left")
    n_hit, ids = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("ids", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, list_slice(ws, s, s + {WINDOW} - 1) AS test FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW} + 1, 1) + 1)) AS s FROM b WHERE len(ws) > 0)),
p AS (SELECT r, s, n, list_slice(ws, s, s + n - 1) AS test FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d CROSS JOIN (SELECT DISTINCT len(test) AS n FROM w) WHERE len(ws) >= n)),
m AS (SELECT p.r, p.s, p.n, w.item_id FROM p JOIN w ON p.test = w.test),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS at FROM m) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM m GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
