"""A table laid out by a key, so that a page or window of it opens the files that hold it and no others.

Rows are dealt out by ranges of the key, sorted, and written in files of a bounded number of rows; beside them lies an index
of a row a file: its least and greatest key and its rows. What a reader opens depends on what it asks for, not on the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a file.
ROWS = 1_000_000


def write(rows: DataFrame, path: str, *key: str, rows_a_file: int = ROWS) -> None:
    """Write rows under path by the columns of key. Rows whose first key column is null are left out of pages and windows."""
    n = max(1, -(-rows.count() // rows_a_file))
    rows.repartitionByRange(n, *key).sortWithinPartitions(*key).write.option("maxRecordsPerFile", rows_a_file).mode("overwrite").parquet(f"{path}/data")
    spark = rows.sparkSession
    found = spark.read.schema(rows.schema).parquet(f"{path}/data").where(F.col(key[0]).isNotNull()).groupBy(F.col("_metadata.file_path").alias("file"))
    found.agg(F.min(key[0]).alias("low"), F.max(key[0]).alias("high"), F.count("*").alias("n")).repartitionByRange(1, "low").sortWithinPartitions("low").write.mode("overwrite").parquet(f"{path}/index")


class Layout:
    def __init__(self, spark: SparkSession, path: str, *key: str) -> None:
        """key: as it was written by; pages and windows go by its first column, rows within them by all."""
        self.spark, self.path, self.key, self.order = spark, path, key[0], key
        self.index = spark.read.parquet(f"{path}/index")
        self.rows = spark.read.parquet(f"{path}/data")

    def _files(self, files: DataFrame) -> DataFrame:
        """The rows of the files named, which are as many as what is asked for takes."""
        names = [r.file for r in files.select("file").collect()]
        return self.spark.read.schema(self.rows.schema).parquet(*names) if names else self.rows.limit(0)

    def page(self, after: object, limit: int) -> DataFrame:
        """The first `limit` rows behind a key (None: from the start), in order. Opens the file that the key falls
        into and those behind it that are needed to fill the page."""
        left = self.index if after is None else self.index.where(F.col("high") > F.lit(after))
        # the first file may hold nothing behind the key but its last row; those wholly behind it count in full
        whole = F.lit(True) if after is None else F.col("low") > F.lit(after)
        order = Window.orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
        before = F.coalesce(F.sum(F.when(whole, F.col("n")).otherwise(0)).over(order), F.lit(0))
        ahead = F.coalesce(F.max("high").over(order), F.col("low"))
        # a file that shares a key with the one before may hold rows of the page however many came before
        needed = left.withColumn("before", before).withColumn("ahead", ahead).where((F.col("before") < limit) | (F.col("low") < F.col("ahead")))
        rows = self._files(needed)
        return (rows if after is None else rows.where(F.col(self.key) > F.lit(after))).orderBy(*self.order).limit(limit)

    def window(self, start: object, end: object, where: Column | None = None) -> DataFrame:
        """The rows whose key lies between start and end (both in)."""
        rows = self._files(self.index.where((F.col("high") >= F.lit(start)) & (F.col("low") <= F.lit(end))))
        rows = rows.where(F.col(self.key).between(F.lit(start), F.lit(end)))
        return rows if where is None else rows.where(where)
