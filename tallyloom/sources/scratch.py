"""A folder for what one job writes for the next."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, which all executors share; where that is unset, a local
    one, if Spark runs on this machine alone (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
        sc.setCheckpointDir(named)
    path = f"{named}/{name}-{uuid.uuid4().hex}"
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
