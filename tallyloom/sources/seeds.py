"""Seed lists, url lists and review lists as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import clean_optional, normalize_url
from ..operators.identity import seed_addresses
from .delimited import records

# Cells that mark a header row.
HEADER_CELLS = ("url", "store url", "store name", "name", "store address", "address", "source_id", "notes")
URL_NAMES, NAME_NAMES, ADDRESS_NAMES = ("url", "store url"), ("store name", "name"), ("store address", "address")
IMAGE_ENDINGS = ("jpg", "jpeg", "png", "webp")
# End of fixed values.


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, cells of the tab-separated files of a folder, quoted cells read as such; rows of blanks go. See
    delimited.records."""
    rows = records(spark, path).withColumn("cells", F.transform("cells", lambda c: F.btrim(c, F.lit(" \r"))))
    return rows.where(F.exists("cells", lambda c: F.btrim(c) != ""))


def looks_like_header(cells: Column) -> Column:
    return F.arrays_overlap(F.transform(cells, lambda c: F.lower(F.trim(c))), F.array(*map(F.lit, HEADER_CELLS)))


def _index(cells: Column, names: tuple[str, ...], default: int) -> Column:
    lower = F.transform(cells, lambda c: F.lower(F.trim(c)))
    found = [F.nullif(F.array_position(lower, n), F.lit(0)) for n in names]
    return F.coalesce(*found, F.lit(default + 1)).cast("int")


def parse_seeds(rows: DataFrame) -> DataFrame:
    """file, line_no, store_url, store_name, addresses, ok of rows (file, line_no, cells).

    A file's first line may name the columns (in any order); else they are url, name, addresses. Where the first cell
    is no url and the second is, the two are swapped. Rows without a url are kept with ok false, as rejects.
    """
    heads = rows.where("line_no = 0").where(looks_like_header(F.col("cells")))
    heads = heads.select("file", _index(F.col("cells"), URL_NAMES, 0).alias("u"), _index(F.col("cells"), NAME_NAMES, 1).alias("n"), _index(F.col("cells"), ADDRESS_NAMES, 2).alias("a"))
    j = rows.join(heads, "file", "left").where("NOT (line_no = 0 AND u IS NOT NULL)")
    cell = lambda k, default: F.try_element_at("cells", F.coalesce(k, F.lit(default)))
    c0, c1 = cell(F.col("u"), 1), cell(F.col("n"), 2)
    plain = lambda c: c.rlike(r"^\S+\.\S+$")
    swap = F.coalesce(~plain(c0), F.lit(True)) & F.coalesce(plain(c1), F.lit(False))
    url = normalize_url(F.when(swap, c1).otherwise(F.when(plain(c0), c0)))
    start = F.coalesce("a", F.lit(3))
    rest = F.slice("cells", start, F.greatest(F.size("cells") - start + 1, F.lit(0)))
    return j.select("file", "line_no", url.alias("store_url"), clean_optional(F.when(swap, c0).otherwise(c1)).alias("store_name"), seed_addresses(rest).alias("addresses"), url.isNotNull().alias("ok"))


def url_list(rows: DataFrame, first: int | None = None) -> DataFrame:
    """ord, store_url of lines (ord, line): the first comma cell, normalised; blanks go; the first so many."""
    found = rows.select("ord", normalize_url(clean_optional(F.split_part("line", F.lit(","), F.lit(1)))).alias("store_url")).where("store_url IS NOT NULL")
    return found.orderBy("ord").limit(first) if first else found


def review_rows(rows: DataFrame) -> DataFrame:
    """id, images of review lines (id, images as JSON text): bad ids are skipped."""
    return rows.select(F.col("id").try_cast("bigint").alias("id"), F.from_json("images", "array<string>").alias("images")).where("id IS NOT NULL")


def labelled_images(spark: SparkSession, path: str, endings: tuple[str, ...] = IMAGE_ENDINGS) -> DataFrame:
    """path, label of the files below a folder that end as images do: the label is the name of the folder they lie in.
    Nothing is decoded, and contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    kept = files.where(F.lower(F.substring_index("path", ".", -1)).isin(*endings))
    return kept.select("path", F.element_at(F.split("path", "/"), -2).alias("label"))
