"""Staged rows of runs: one table of snapshots a run, upserted by key, read whole, dropped with the run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import last_of, merge_frames
from .snapshots import Snapshots


class Staging:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], ordinal: str) -> None:
        """keys: what a staged row is known by within its run (website first); ordinal: the column that orders rows."""
        self.spark, self.path, self.keys, self.ordinal = spark, path.rstrip("/"), keys, ordinal

    def _table(self, run_id: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.path}/run={run_id}")

    def stage(self, run_id: str, rows: DataFrame, batch: int | None = None, writer: str = "") -> int:
        """Upsert rows, all columns overwritten, the last of a key by ordinal; a batch of a writer that comes again changes
        nothing. Writers may stage for one run at once. The version that this made."""

        def change(old: DataFrame | None) -> DataFrame:
            new = last_of(rows, self.keys, self.ordinal)
            return new if old is None else merge_frames(old, new.select(*old.columns), self.keys, dict.fromkeys(old.columns, "overwrite"))

        return self._table(run_id).commit(change, writer, batch)

    def read(self, run_id: str, website: str | None = None, version: int | None = None) -> DataFrame | None:
        """What is staged for a run, or for one website of it, in the order of ordinal, as of a version (None: the last)
        that is kept; None where nothing ever was."""
        rows = self._table(run_id).read(version)
        if rows is None:
            return None
        rows = rows if website is None else rows.where(F.col(self.keys[0]) == website)
        return rows.orderBy(self.ordinal)

    def websites(self, run_id: str) -> DataFrame | None:
        """The websites that something is staged for, in order of their first rows."""
        rows = self._table(run_id).read()
        return None if rows is None else rows.groupBy(self.keys[0]).agg(F.min(self.ordinal).alias("_o")).orderBy("_o", self.keys[0]).select(self.keys[0])

    def runs(self) -> list[str]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        files = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []
        return sorted(n.removeprefix("run=") for n in names if n.startswith("run="))

    def purge(self, *run_ids: str) -> None:
        """Drop all that is staged for runs; unknown ones are passed over."""
        for run_id in run_ids:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/run={run_id}")
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
