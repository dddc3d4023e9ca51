"""What the corpus operators share: reading a table and cutting lineage."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: The folders of tables cut within the innermost passing().
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset, a local one, if Spark runs on this
    machine alone (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: a lost executor then costs a reread, not the
    whole lineage. The folder goes with the passing() that it is cut in, or when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (own := _PASSING.get()) is not None:
        own.append(path)
    df.write.parquet(path)
    files, where = _folder(spark, path)
    files.deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str) -> tuple:
    """The file system of a folder, and its path there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables cut within are deleted at the end, so that disk holds them no longer than they are read; nothing may read
    them later. What is cut by the function given stays: it belongs to what encloses this."""
    outer, own = _PASSING.get(), []

    def leave(df: DataFrame, name: str) -> DataFrame:
        inside = _PASSING.set(outer)
        try:
            return cut(df, name)
        finally:
            _PASSING.reset(inside)

    before = _PASSING.set(own)
    try:
        yield leave
    finally:
        _PASSING.reset(before)
        for path in own:
            with contextlib.suppress(Py4JJavaError):  # then it goes when the JVM ends
                files, where = _folder(spark, path)
                files.delete(where, True)


def give_back() -> None:
    """Hand memory that this process has freed back to the system: Python workers live on between stages, and executors
    are small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, which are Python objects no longer than they are worked on."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        give_back()
