"""Delimited text with quoted cells that may hold the delimiter, quotes and line ends, read by line and split among tasks.

Whether a line begins inside a quoted cell depends on all lines before it, but a line can only do four things to the answer:
keep it, set it to inside, set it to outside, or (a line that both opens and closes) turn it round. These compose, so a
running sum over a file's lines tells it for each: the last line that sets it, and the turns since. The sum is taken
within each split of a file first, then over the splits, a row each.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The quote sign.
QUOTE = '"'
# End of fixed values.


def _patterns(delimiter: str) -> tuple[str, str, str, str]:
    """A cell; a line that begins outside a cell and ends inside one; one that begins inside and closes it; one that begins
    inside and ends inside. A quote opens a cell only as its first sign, and is doubled within."""
    d = re.escape(delimiter)
    inner = rf"[^{QUOTE}]*+(?:{QUOTE}{QUOTE}[^{QUOTE}]*+)*+"
    quoted, plain = rf"{QUOTE}{inner}{QUOTE}[^{d}]*+", rf"[^{QUOTE}{d}][^{d}]*+"
    whole = rf"(?:(?:{quoted}|{plain})?+{d})*+"
    opens = rf"{whole}{QUOTE}{inner}$"
    closed = rf"^{inner}{QUOTE}(?!{QUOTE})"
    return rf"{d}({QUOTE}{inner}{QUOTE}?+[^{d}]*+|[^{d}]*+)", rf"^{opens}", closed, rf"^(?:{inner}$|{inner}{QUOTE}(?!{QUOTE})[^{d}]*+{d}{opens})"


def split_cells(record: Column, delimiter: str = "\t") -> Column:
    """A record's cells: of a quoted one what is between its quotes, doubled ones single, and what follows up to the
    delimiter; others as they are. A quote that is never closed takes the rest."""
    cell, *_ = _patterns(delimiter)
    inner = rf"^{QUOTE}([^{QUOTE}]*+(?:{QUOTE}{QUOTE}[^{QUOTE}]*+)*+)"
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), record), F.lit(rf"(?s){cell}"), F.lit(1))
    text = lambda c: F.concat(F.replace(F.regexp_extract(c, rf"(?s){inner}", 1), F.lit(QUOTE * 2), F.lit(QUOTE)), F.regexp_extract(c, rf"(?s){inner}{QUOTE}(.*)", 2))
    return F.transform(found, lambda c: F.when(c.startswith(QUOTE), text(c)).otherwise(c))


def records(spark: SparkSession, path: str, delimiter: str = "\t") -> DataFrame:
    """file, line_no (of the record's first line, from 0), cells of the text files of a folder.

    Line ends are line feeds, with or without a carriage return. Lines that are empty outside quotes give no record. A file is read
    in splits as large as Spark makes them; no task holds a file, and none more of one than a record or a split's
    keys. A quote that is never closed makes one record of the rest of its file.
    """
    _, opens, _, stays = _patterns(delimiter)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    quoted = F.contains("value", F.lit(QUOTE))
    out_in, in_in = quoted & F.col("value").rlike(rf"(?s){opens}"), ~quoted | F.col("value").rlike(rf"(?s){stays}")
    lines = lines.withColumn("out_in", out_in).withColumn("in_in", in_in)
    sets, turns = F.when(F.col("out_in") == F.col("in_in"), F.col("in_in")), (F.col("out_in") & ~F.col("in_in")).cast("int")

    # within a split: lines so far, turns so far, and at the last line that sets the answer what it sets and the turns then
    by = Window.partitionBy("path", "block").orderBy("id")
    lines = lines.withColumn("sets", sets).withColumn("turned", F.sum(turns).over(by)).withColumn("nth", F.row_number().over(by))
    lines = lines.withColumn("set_at", F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "turned")), ignorenulls=True).over(by))
    ends = lines.groupBy("path", "block").agg(F.max("nth").alias("n"), F.max(F.struct("nth", "turned", "set_at")).alias("e"))
    # over the splits of a file, a row each
    over = Window.partitionBy("path").orderBy("block")
    ahead = over.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("path", "block", "n", F.col("e.turned").alias("turns"), F.col("e.set_at").alias("set_at")).withColumn("turned", F.sum("turns").over(over))
    at = F.when(F.col("set_at").isNotNull(), F.struct(F.col("set_at.sets").alias("sets"), (F.col("turned") - F.col("turns") + F.col("set_at.turned")).alias("turned")))
    ends = ends.withColumn("at", at).withColumn("last", F.last("at", ignorenulls=True).over(ahead)).withColumn("so_far", F.coalesce(F.sum("turns").over(ahead), F.lit(0)))
    odd = lambda n: n % 2 == 1
    begins = F.coalesce(F.col("last.sets"), F.lit(False)) != odd(F.col("so_far") - F.coalesce(F.col("last.turned"), F.lit(0)))
    ends = ends.select("path", "block", begins.alias("begins"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))

    lines = lines.join(ends, ["path", "block"])
    closes = F.when(F.col("set_at").isNotNull(), F.col("set_at.sets") != odd(F.col("turned") - F.col("set_at.turned"))).otherwise(F.col("begins") != odd(F.col("turned")))
    lines = lines.select("path", "file", "block", "value", (F.col("base") + F.col("nth") - 1).cast("int").alias("line_no"), closes.alias("goes_on"), "begins")
    order = Window.partitionBy("path", "block").orderBy("line_no")
    lines = lines.withColumn("inside", F.coalesce(F.lag("goes_on").over(order), F.col("begins")))
    # the first line of the record that a line belongs to: in its split, else the last one begun in a split before
    lines = lines.withColumn("own", F.last(F.when(~F.col("inside"), F.col("line_no")), ignorenulls=True).over(order))
    last = lines.groupBy("path", "block").agg(F.max("own").alias("_own")).withColumn("before", F.last("_own", ignorenulls=True).over(ahead)).select("path", "block", "before")
    lines = lines.join(last, ["path", "block"]).withColumn("first", F.coalesce("own", "before"))

    single = lines.where("NOT inside AND NOT goes_on").select("file", "line_no", "value")
    parts = lines.where("inside OR goes_on").groupBy("path", "file", F.col("first").alias("line_no")).agg(F.array_sort(F.collect_list(F.struct(F.col("line_no").alias("at"), "value"))).alias("all"))
    whole = single.unionByName(parts.select("file", "line_no", F.array_join(F.transform("all", lambda x: x["value"]), "\n").alias("value")))
    text = F.regexp_replace("value", r"\r$", "")
    return whole.select("file", "line_no", text.alias("value")).where("value <> ''").select("file", "line_no", split_cells(F.col("value"), delimiter).alias("cells"))
