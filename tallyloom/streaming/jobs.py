"""Streams of landed pages and heartbeats. Each runs what has arrived and stops; progress is in its checkpoint."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import catalog as C
from ..operators import reconcile as R
from ..sources.snapshots import Snapshots

#: Rows of a Parquet file that a stream's scan holds at once. Spark's 4,096 are a gigabyte where a page's body has 250 KB.
PAGES_A_BATCH = 64


@contextmanager
def page_wise(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within read wide rows, a few at once. (A stream has a copy of the settings as they are when
    it starts.)"""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PAGES_A_BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def arrivals(spark: SparkSession, path: str, schema: StructType, files: int = 4) -> DataFrame:
    """Rows of the Parquet files that land in a folder, a few files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int, str], None]) -> None:
    """Hand every micro-batch that is there to batch(rows, number, writer), then stop. A batch may come twice after a failure.
    writer is the name that the checkpoint has given its query: batch numbers start anew in a new checkpoint, also in
    one of the same path."""
    writer: list[str] = []
    named = threading.Event()

    def each(rows: DataFrame, number: int) -> None:
        named.wait()
        batch(rows, number, writer[0])

    with page_wise(stream.sparkSession):
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    writer.append(query.id)
    named.set()
    query.awaitTermination()


def versioned(spark: SparkSession, stream: DataFrame, state: str, checkpoint: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> DataFrame | None:
    """The state after all that has arrived: merge(state or None, rows) for every micro-batch, then stop.

    Each batch is a version of a Snapshots table. A batch that is replayed changes nothing, a job that is started anew goes on
    from what the table holds, and several streams with checkpoints of their own may feed one table, also at once.
    """
    table = Snapshots(spark, state)
    run(stream, checkpoint, lambda rows, number, writer: table.commit(lambda old: merge(old, rows), writer, number))
    return table.read()


def ingest(spark: SparkSession, pages: DataFrame, state: str, checkpoint: str, columns: list[str], keys: tuple[str, ...] = C.PRODUCT) -> DataFrame | None:
    """Pages extracted and upserted into a state by keys as they arrive (see versioned); nothing ever arrived: None. With keys
    PLACE an id that stands at two places of a catalog has two rows, told apart by pos."""
    keys = list(keys)

    def upsert(old: DataFrame | None, rows: DataFrame) -> DataFrame:
        new = C.extract_catalog(rows).withColumn("ord", F.col("page") * 100_000 + F.col("pos")).select(*keys, "ord", *columns)
        new = R.last_of(new, keys, "ord").drop("ord")
        return new if old is None else R.merge_frames(old, new, keys, {c: "overwrite" for c in columns})

    return versioned(spark, pages, state, checkpoint, upsert)


def first_seen(pages: DataFrame, keys: tuple[str, ...] = C.PRODUCT) -> DataFrame:
    """A stream's products (landed, domain, pos, product_id), each (domain, product_id) once within the watermark of
    `landed`; or each place, see first_seen_products."""
    rows = pages.withWatermark("landed", "1 hour").select("landed", "domain", F.posexplode(F.from_json("body", C.SCHEMA)["products"]).alias("pos", "p"))
    rows = rows.where("p.id IS NOT NULL AND p.id NOT IN ('', '0')").select("landed", "domain", "pos", F.col("p.id").alias("product_id"))
    return rows.dropDuplicatesWithinWatermark(list(keys))


def idle_sessions(beats: DataFrame, idle: str, watermark: str | None = None, terminal: tuple[str, ...] = (), hard_seconds: int | None = None) -> DataFrame:
    """store, start, end, beats, verdict: runs of heartbeats (store, ts, kind) without a gap of `idle`; works on streams
    with a watermark.

    finished: a terminal kind is in the run. over limit: the run's beats lie further apart than hard_seconds. stalled:
    it went idle without either.
    """
    rows = beats.withWatermark("ts", watermark) if watermark else beats
    ended = F.max(F.col("kind").isin(*terminal) if terminal else F.lit(False))
    rows = rows.groupBy("store", F.session_window("ts", idle).alias("s")).agg(F.count("*").alias("beats"), ended.alias("ended"), (F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))).alias("length"))
    verdict = F.when(F.col("ended"), "finished").when(F.col("length") > (hard_seconds or 1 << 40) * 1_000_000, "over limit").otherwise("stalled")
    return rows.select("store", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "beats", verdict.alias("verdict"))


def live_counts(beats: DataFrame, width: str, watermark: str | None = None) -> DataFrame:
    """start, kind, n, latest (the last ts): counts in tumbling windows."""
    rows = beats.withWatermark("ts", watermark) if watermark else beats
    return rows.groupBy(F.window("ts", width).alias("w"), "kind").agg(F.count("*").alias("n"), F.max("ts").alias("latest")).select(F.col("w.start").alias("start"), "kind", "n", "latest")


def live_deltas(counts: DataFrame) -> DataFrame:
    """live_counts with `delta`, how many more than in the kind's window before (in the first, all), and `fresh`, whether
    the kind was seen later than before. For tables, as a stream has no window before."""
    before = Window.partitionBy("kind").orderBy("start")  # a row for each window
    return counts.withColumn("delta", F.col("n") - F.coalesce(F.lag("n").over(before), F.lit(0))).withColumn("fresh", F.coalesce(F.col("latest") > F.lag("latest").over(before), F.lit(True)))


def two_phase(spark: SparkSession, pages: DataFrame, staging: str, saved: str, progress: str, run_id: str, keep: Callable[[DataFrame], DataFrame], keys: tuple[str, ...] = C.PRODUCT) -> DataFrame:
    """Phase 1 stages the products of pages for a run; phase 2 takes what is staged for it, saves what `keep` leaves, each
    (domain, product_id) once (or each place, see first_seen_products), as it was staged last, and clears the staging. Both resume by run id: their checkpoints
    are named after it, a staged batch that comes again writes the same folder, and one saved again changes nothing. What
    this run has saved, as a table; an empty one if nothing arrived."""
    stage, keys = f"{staging}/run={run_id}", list(keys)
    schema = C.extract_catalog(spark.createDataFrame([], pages.schema)).schema
    order = F.col("page") * 100_000 + F.col("pos")
    run(pages, f"{progress}/{run_id}/phase1", lambda rows, number, writer: C.extract_catalog(rows).write.mode("overwrite").parquet(f"{stage}/{writer}-{number}"))
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(stage)
    fs = where.getFileSystem(sc._jsc.hadoopConfiguration())
    table = Snapshots(spark, f"{saved}/run={run_id}")

    def save(old: DataFrame | None, rows: DataFrame) -> DataFrame:
        new = R.last_of(keep(rows).withColumn("_ord", order), keys, "_ord").drop("_ord")
        return new if old is None else R.merge_frames(old, new, keys, dict.fromkeys(schema.names, "overwrite"))

    if fs.exists(where):
        staged = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(stage)
        run(staged, f"{progress}/{run_id}/phase2", lambda rows, number, writer: table.commit(lambda old: save(old, rows), writer, number))
        fs.delete(where, True)
    found = table.read()
    return spark.createDataFrame([], schema) if found is None else found


def collected(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """What a stream appends, as a table."""
    with page_wise(stream.sparkSession):
        query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
