"""Exact inner-product top-k by norm buckets.

Vectors are grouped by length (a bucket's norms differ by a few per cent) and cut into blocks of a bounded number of
rows; queries are cut into blocks too, so a task holds one block of each and no group is unbounded. First every query
block meets the block of its longest candidates, which gives each query a score that its k-th best reaches at least.
With that a block's local cosine threshold is theta / (|q| * longest): above 1 the pair is pruned by length alone; else
rows are pruned by their own length, or, where the threshold is high, by coordinates: what the largest coordinates of
the query leave open is bounded by Cauchy-Schwarz. What is left is verified by exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

SCALE = 1024
K = 10
QUERY_EVERY = 100
#: Norms of a bucket are within this ratio; rows of a block, of candidates and of queries.
RATIO = 1.05
BLOCK_ROWS, QUERY_ROWS = 4096, 2048
#: A double below this is cut down to whole 1 / SCALE, one above it is whole; from LARGE on a vector's products are not
#: taken as doubles, from GREAT on its squares say nothing.
WHOLE, LARGE, GREAT = float(2**42), float(2**20), 1e150
#: From this local cosine threshold on, rows are pruned by coordinates, by so many of the query's largest.
HIGH_COSINE, FOCUS = 0.5, 8
SCHEMA = "query_id long, vec_id long, score long"


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """row, vec_id, v (array of double: floor(1024 * x) / 1024, which a double holds exactly), norm. Vectors that are null or
    empty or hold null or non-finite components, and null vec_ids, are left out. row tells rows apart, equal ones too."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = embeddings.select("vec_id", F.col("embedding").cast("array<double>")).where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(fine)
    floor = lambda x: F.when(F.abs(x) < WHOLE, F.floor(x * SCALE) / F.lit(float(SCALE))).otherwise(x)
    some = some.select(F.col("vec_id").cast("long"), F.transform("embedding", floor).alias("v"))
    some = some.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)) * SCALE)
    return some.withColumn("row", F.monotonically_increasing_id())


def matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of the same width; shorter vectors are filled up with 0."""
    out = np.zeros((len(column), width))
    for k, v in enumerate(column):
        out[k, : len(v)] = v
    return out


def _integers(x: np.ndarray) -> np.ndarray:
    """Components times SCALE as integers of any size."""
    return np.array([[int(y * SCALE) if abs(y) < GREAT else int(y) * SCALE for y in row] for row in x.tolist()], object).reshape(x.shape)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products, those beyond 64 bits as the last number there: doubles where none can pass 2**53,
    64-bit integers where none can pass 2**63, else integers of any size. Rows of great components go by themselves."""
    parts = [[np.flatnonzero(large == side) for side in (False, True)] for large in ((np.abs(x) * SCALE >= LARGE).any(1) for x in (q, c))]
    if parts[0][1].size or parts[1][1].size:
        out = np.empty((len(q), len(c)), np.int64)
        for a in parts[0]:
            for b in parts[1]:
                if a.size and b.size:
                    out[np.ix_(a, b)] = _products(q[a], c[b])
        return out
    return _products(q, c)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        most = float(np.abs(q).max(initial=0) * SCALE) * float(np.abs(c).max(initial=0) * SCALE) * q.shape[1]
    if most < 2**53:
        return ((q * SCALE) @ (c * SCALE).T).astype(np.int64)
    if most < 2**62:
        return (q * SCALE).astype(np.int64) @ (c * SCALE).astype(np.int64).T
    least, greatest = -(2**63), 2**63 - 1
    return np.array([[min(max(int(x), least), greatest) for x in row] for row in _integers(q) @ _integers(c).T], np.int64).reshape(len(q), len(c))


def best(query_id: np.ndarray, q: np.ndarray, theta: np.ndarray, vec_id: np.ndarray, c: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of a block of candidates, for each query its k best of a score of theta or more."""
    out = []
    with np.errstate(over="ignore"):
        q_norm, c_norm = (np.sqrt((x**2).sum(1)) * SCALE for x in (q, c))
    order = np.argsort(-c_norm, kind="stable")
    vec_id, c, c_norm = vec_id[order], c[order], c_norm[order]
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        local = np.where(q_norm * c_norm[0] > 0, theta / (q_norm * c_norm[0]), np.where(theta > 0, 2.0, -1.0))
    local[np.isnan(local)] = -1.0  # lengths beyond a double leave it open
    slack = 1 + 1e-9
    live = np.flatnonzero(local <= slack)
    high = (local[live] >= HIGH_COSINE) & (q_norm[live] < GREAT) & (c_norm[0] < GREAT)

    def keep(row: int, at: np.ndarray, score: np.ndarray) -> None:
        ok = (score >= theta[row]) & (vec_id[at] != query_id[row])
        at, score = at[ok], score[ok]
        if score.size > k:
            edge = np.partition(score, score.size - k)[score.size - k]
            at, score = at[score >= edge], score[score >= edge]
            first = np.lexsort((vec_id[at], -score))[:k]
            at, score = at[first], score[first]
        out.append((np.full(at.size, query_id[row]), vec_id[at], score))

    plain = live[~high]
    for start in range(0, plain.size, 256):
        rows = plain[start : start + 256]
        # lengths fall: the rows that can reach a query's theta come first
        with np.errstate(over="ignore", invalid="ignore"):
            reach = [int(np.searchsorted(-c_norm * q_norm[r] * slack, -theta[r], side="right")) if theta[r] > 0 else c_norm.size for r in rows]
        if (longest := max(reach)) > 0:
            for r, n, score in zip(rows, reach, products(q[rows], c[:longest]), strict=True):
                keep(r, np.arange(n), score[:n])
    for r in live[high]:
        n = int(np.searchsorted(-c_norm * q_norm[r] * slack, -theta[r], side="right"))
        if not n:
            continue
        focus = np.argsort(-np.abs(q[r]), kind="stable")[:FOCUS]
        qf, cf = q[r, focus] * SCALE, c[:n, focus] * SCALE
        q_rest = np.sqrt(max(0.0, q_norm[r] ** 2 - (qf**2).sum()))
        c_rest = np.sqrt(np.maximum(0.0, c_norm[:n] ** 2 - (cf**2).sum(1)))
        at = np.flatnonzero(cf @ qf + q_rest * c_rest * slack + 1e-6 * abs(theta[r]) + 1 >= theta[r])
        if at.size:
            keep(r, at, products(q[r : r + 1], c[at])[0])
    return out


def _search(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or candidates.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        width = max(queries.v.map(len).max(), candidates.v.map(len).max())
        found = best(queries.vec_id.to_numpy(), matrix(queries.v, width), queries.theta.to_numpy(np.float64), candidates.vec_id.to_numpy(), matrix(candidates.v, width), k)
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        query_id, vec_id, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})

    return run


def top_products(embeddings: DataFrame, k: int = K, query_every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose vec_id is divisible by query_every its k highest inner
    products with rows of another vec_id (all, if fewer), ties to the smaller vec_id.

    Shorter vectors count as filled up with 0. Rows that repeat a vec_id are candidates of their own, and as queries
    one (with the same vector; with different ones, each row asks and the best k of all answers are kept). Vectors
    that take no part: see whole_vectors. Scores are exact; one beyond the 64 bits of a long is the last long there, and such
    scores are ties. Other columns are dropped. No rows give no rows.
    """
    spark = embeddings.sparkSession
    vectors = cut(whole_vectors(embeddings), "vectors")
    group = F.when(F.col("norm") > 0, F.floor(F.log(F.least("norm", F.lit(GREAT))) / float(np.log(RATIO)))).otherwise(F.lit(-1)).cast("int")
    vectors = vectors.withColumn("bucket", group)
    sizes = cut(vectors.groupBy("bucket").agg(F.count("*").alias("n")), "buckets")  # a row for each 5 % of length
    few = F.col("n") < BLOCK_ROWS // 2
    before = F.sum(F.when(few, F.col("n")).otherwise(0)).over(Window.orderBy(F.desc("bucket")))
    # a large bucket in parts of about BLOCK_ROWS, small ones together
    sizes = sizes.withColumn("base", F.when(few, -2 - F.floor(before / BLOCK_ROWS)).otherwise(F.col("bucket")).cast("int"))
    sizes = sizes.select("bucket", "base", F.when(few, 1).otherwise(F.ceil(F.col("n") / BLOCK_ROWS)).cast("int").alias("parts"))
    placed = vectors.join(F.broadcast(sizes), "bucket")
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")  # equal rows are dealt out as others
    placed = placed.withColumn("block", F.struct(F.col("base").alias("bucket"), part.alias("part")))
    placed = cut(placed.select("vec_id", "v", "norm", "block"), "blocks")
    blocks = cut(placed.groupBy("block").agg(F.max("norm").alias("longest"), F.count("*").alias("rows")), "lengths")

    asked = placed.where(F.pmod(F.col("vec_id"), F.lit(query_every)) == 0).select("vec_id", "v", "norm").distinct()
    n_queries = asked.count()
    asked = asked.withColumn("ask", F.pmod(F.xxhash64("vec_id", F.hash("v")), F.lit(max(1, -(-n_queries // QUERY_ROWS)))).cast("int"))
    asked = cut(asked, "queries")
    asks = asked.select("ask").distinct()

    # the longest candidates first: blocks from the longest on until k + 1 rows are there
    first = Window.orderBy(F.desc("longest"), "block")
    ahead = blocks.orderBy(F.desc("longest"), "block").limit(k + 1)
    ahead = ahead.withColumn("_before", F.sum("rows").over(first) - F.col("rows")).where(F.col("_before") <= k).select("block").collect()  # k + 1 at most
    if not ahead:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    probe = cut(_met(asked.withColumn("theta", F.lit(float("-inf"))), placed, asks.withColumn("block", F.explode(F.array(*(F.struct(F.lit(r.block.bucket).alias("bucket"), F.lit(r.block.part).alias("part")) for r in ahead)))), k), "probed")
    reached = _ranked(probe, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("theta"))
    bounded = asked.join(reached, asked.vec_id == reached.query_id, "left").select("ask", "vec_id", "v", "norm", F.coalesce("theta", F.lit(float("-inf"))).alias("theta"))
    if n_queries > QUERY_ROWS:  # queries that need candidates as long as each other come together, so that blocks are left out
        bounded = cut(bounded, "reached").repartitionByRange(-(-n_queries // QUERY_ROWS), F.col("theta") / F.col("norm"), "vec_id").withColumn("ask", F.spark_partition_id())
    bounded = cut(bounded, "bounded")
    # blocks that some query of the block of queries may still find something in
    need = bounded.groupBy("ask").agg(F.min(F.when(F.col("theta") > 0, F.col("theta") / F.col("norm")).otherwise(F.lit(0.0))).alias("need"))
    rest = blocks.where(~F.struct("block.bucket", "block.part").isin(*(F.struct(F.lit(r.block.bucket).alias("bucket"), F.lit(r.block.part).alias("part")) for r in ahead))).select("block", "longest")
    # pairs of blocks, not of rows: a stated query set against all rows, in blocks
    pairs = need.join(rest, F.col("longest") * (1 + 1e-9) >= F.col("need")).select("ask", "block")
    found = _met(bounded, placed, pairs, k)
    return _ranked(probe.unionByName(found), k).select("query_id", "rank", "vec_id", "score")


def _met(asked: DataFrame, placed: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Each pair (ask, block) of blocks in one task."""
    pairs = cut(pairs, "pairs")
    left = asked.join(pairs, "ask").select("ask", "block", "vec_id", "v", "theta")
    right = placed.join(pairs, "block").select("ask", "block", "vec_id", "v")
    return left.groupBy("ask", "block").cogroup(right.groupBy("ask", "block")).applyInPandas(_search(k), SCHEMA)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


ORACLE_SQL = f"""
WITH fine AS (SELECT vec_id, embedding, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM fine q JOIN fine c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
