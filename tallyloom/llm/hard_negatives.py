"""Exact hard-negative mining with bounds along a spanning tree of anchors.

Anchors come in groups of a bounded number, candidates in blocks; a task holds one of each. A group's anchors are joined by
a minimum spanning tree of Euclidean distances. Where an anchor's scores are known or bounded for a block, those of its
child in the tree differ by no more than edge * |candidate| (Cauchy-Schwarz), so each candidate has an interval for the
child; only candidates whose interval overlaps the window that is looked for are scored again, exactly. For positives the
window is what can still be among the best of the block, for negatives the union of the windows that the anchor's
positives set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .norm_search import GREAT, SCALE, matrix, products
from .shared import cut

UNITS, ANCHOR_EVERY, MOVED_EVERY, LABELS = 256, 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of the positive's: from and to.
LOW, HIGH = 50, 95
#: Anchors of a group, candidates of a block, label buckets at most.
GROUP_ROWS, BLOCK_ROWS, BUCKETS = 512, 4096, 64
#: From here on a double is a whole number of units; scores from FAR on may have been cut down to a long.
WHOLE, FAR = float(2**44), 2**62


def mined_vectors(embeddings: DataFrame) -> DataFrame:
    """row, vec_id, label, v (array of double: floor(256 * x) / 1024), norm (of floor(256 * x)), written. Rows with a
    null vec_id, label or vector, an empty vector, or a null or non-finite component are left out. row tells rows apart."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    some = some.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(fine)
    unit = lambda x: F.when(F.abs(x) < WHOLE, F.floor(x * UNITS) / F.lit(float(SCALE))).otherwise(x * (UNITS / SCALE))
    label = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    some = some.select("vec_id", label.alias("label"), F.transform("embedding", unit).alias("v"))
    some = some.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)) * SCALE)
    return cut(some.withColumn("row", F.monotonically_increasing_id()), "mined")


def _parted(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Add part, so that no (keys, part) has much more than size rows, however many rows a key has."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    return rows.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """order, parent, edge: the rows of v as Prim's algorithm reaches them from the first, the row that each hangs from (-1: the
    first) and its distance from there in units."""
    n = len(v)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.full(n, np.inf)
    away = np.ones(n, bool)
    at = 0
    edge[0] = 0.0
    for k in range(n):
        order[k], away[at] = at, False
        if k + 1 == n:
            break
        with np.errstate(over="ignore", invalid="ignore"):
            far = np.sqrt(((v - v[at]) ** 2).sum(1)) * SCALE
        far[np.isnan(far)] = np.inf
        nearer = away & ((far < edge) | (parent < 0))
        parent[nearer], edge[nearer] = at, far[nearer]
        at = int(np.flatnonzero(away)[np.argmin(edge[away])])
    return order, parent, edge


TREE = "row long, vec_id long, label long, v array<double>, norm double, grp string, bucket int, place int, parent int, edge double"


def _planted(group: pd.DataFrame) -> pd.DataFrame:
    """A group's anchors in the order of its tree: place, parent (a place; -1: the root), edge."""
    group = group.sort_values("row", ignore_index=True)
    order, parent, edge = spanning_tree(matrix(group.v, group.v.map(len).max()))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    group["place"], group["parent"], group["edge"] = place, np.where(parent < 0, -1, place[parent]), edge
    return group[[x.split()[0] for x in TREE.split(", ")]]


class Block:
    """A block of candidates, and for every anchor of a walk the bounds of its scores there."""

    def __init__(self, candidates: pd.DataFrame, width: int):
        self.vec_id, self.label, self.norm, self.v = candidates.vec_id.to_numpy(), candidates.label.to_numpy(), candidates.norm.to_numpy(), matrix(candidates.v, width)
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.rescored = 0

    def start(self, parent: int, edge: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each candidate, from those at the parent; open at a root or beyond doubles."""
        n = self.vec_id.size
        if parent < 0 or not edge < GREAT:
            return np.full(n, -np.inf), np.full(n, np.inf)
        low, high = self.bounds[parent]
        with np.errstate(over="ignore", invalid="ignore"):
            reach = edge * self.norm * (1 + 1e-9) + 1
            return low - reach - 1e-9 * np.abs(low), high + reach + 1e-9 * np.abs(high)

    def score(self, anchor: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Exact scores of the candidates at; their bounds become those scores."""
        self.rescored += at.size
        got = products(anchor[None, :], self.v[at] if at.size < self.vec_id.size else self.v)[0]
        sure = np.abs(got.astype(np.float64)) < FAR
        low[at], high[at] = np.where(sure, got, -np.inf), np.where(sure, got, np.inf)
        return got


def _first(at: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores and their places, ties to the smaller vec_id."""
    if score.size > k:
        edge = np.partition(score, score.size - k)[score.size - k]
        at, score = at[score >= edge], score[score >= edge]
    order = np.lexsort((vec_id[at], -score))[:k]
    return at[order], score[order]


def walk(anchors: pd.DataFrame, block: Block, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor, in the order of the tree: its number, the candidates that wanted(number, low, high) asks for by
    their bounds (a mask), and their scores. Bounds of an anchor are dropped behind its last child."""
    v = matrix(anchors.v, block.v.shape[1])
    parents, edges = anchors.parent.to_numpy(), anchors.edge.to_numpy()
    last = {p: k for k, p in enumerate(parents.tolist())}
    for k in range(len(anchors)):
        low, high = block.start(parents[k], edges[k])
        mask = np.ones(block.vec_id.size, bool) if parents[k] < 0 else wanted(k, low, high)
        at = np.flatnonzero(mask)
        score = block.score(v[k], at, low, high) if at.size else np.zeros(0, np.int64)
        if k in last:
            block.bounds[k] = (low, high)
        if last.get(parents[k]) == k:
            block.bounds.pop(parents[k], None)
        yield k, at, score


def positives_of(anchors: pd.DataFrame, block: Block, k: int) -> list[tuple[int, int, int]]:
    """(anchor's row, vec_id, score) of the block's k best of each anchor's label."""
    own, label, row = anchors.vec_id.to_numpy(), anchors.label.to_numpy(), anchors.row.to_numpy()
    fits = lambda a: (block.label == label[a]) & (block.vec_id != own[a])

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mask = fits(a)
        sure = low[mask]
        if sure.size > k:  # k candidates reach this score at least
            mask &= ~(high < np.partition(sure, sure.size - k)[sure.size - k])
        return mask

    out = []
    for a, at, score in walk(anchors, block, wanted):
        ok = fits(a)[at]
        at, score = _first(at[ok], score[ok], block.vec_id, k)
        out += [(row[a], i, s) for i, s in zip(block.vec_id[at].tolist(), score.tolist(), strict=True)]
    return out


def window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative: LOW and HIGH hundredths of the positive's. (Empty below 0.)"""
    return -(-LOW * positive // 100), HIGH * positive // 100


def negatives_of(anchors: pd.DataFrame, block: Block, k: int) -> list[tuple[int, int, int, int]]:
    """(anchor's row, place of the positive, vec_id, score) of the block's first k of another label in each window."""
    label, row = anchors.label.to_numpy(), anchors.row.to_numpy()
    windows = [[(j, *window(int(p))) for j, p in enumerate(scores)] for scores in anchors.positives]
    windows = [[(j, low, high) for j, low, high in own if low <= high] for own in windows]

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mask = block.label != label[a]
        if not windows[a]:
            return mask & False
        return mask & ~((high < float(min(w[1] for w in windows[a])) * (1 - 1e-9) - 1) | (low > float(max(w[2] for w in windows[a])) * (1 + 1e-9) + 1))

    out = []
    for a, at, score in walk(anchors, block, wanted):
        ok = (block.label[at] != label[a])
        at, score = at[ok], score[ok]
        for j, low, high in windows[a]:
            inside = (score >= low) & (score <= high)
            for i, s in zip(*(x.tolist() for x in _first(at[inside], score[inside], block.vec_id, k)), strict=True):
                out.append((row[a], j, int(block.vec_id[i]), s))
    return out


def _task(find: Callable, k: int, names: list[str]) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(anchors: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if anchors.empty or candidates.empty:
            return pd.DataFrame({x: [] for x in names}, dtype="int64")
        anchors = anchors.sort_values("place", ignore_index=True)
        width = max(anchors.v.map(len).max(), candidates.v.map(len).max())
        return pd.DataFrame(find(anchors, Block(candidates, width), k), columns=names, dtype="int64")

    return run


def _met(trees: DataFrame, placed: DataFrame, pairs: DataFrame, find: Callable, k: int, names: list[str]) -> DataFrame:
    """Each pair (grp, block) in one task."""
    pairs = cut(pairs, "pairs")
    columns = [x for x in ("row", "vec_id", "label", "v", "place", "parent", "edge", "positives") if x in trees.columns]
    left = trees.join(pairs, "grp").select("grp", "block", *columns)
    right = placed.join(pairs, "block").select("grp", "block", "vec_id", "label", "v", "norm")
    return left.groupBy("grp", "block").cogroup(right.groupBy("grp", "block")).applyInPandas(_task(find, k, names), ", ".join(f"{x} long" for x in names))


def hard_negatives(embeddings: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (vec_id divisible by
    anchor_every) and each of its first positives of the same label, the first negatives of another label whose score lies
    between LOW and HIGH hundredths of the positive's.

    Scores are exact integer inner products, higher first, ties to the smaller vec_id; one beyond a long is the last long
    there. Shorter vectors count as filled up with 0. Rows that repeat a vec_id are candidates of their own, but never
    of an anchor of that vec_id; equal anchor rows are one anchor, different ones under one vec_id are one each, and
    positives that repeat are one each. Rows that take no part: see mined_vectors. Other columns are dropped. No rows
    give no rows.
    """
    vectors = mined_vectors(embeddings)
    asked = vectors.where(F.col("vec_id") % anchor_every == 0)
    asked = cut(asked.groupBy("vec_id", "label", "v").agg(F.min("row").alias("row"), F.first("norm").alias("norm")), "anchors")
    n = asked.count()
    buckets = min(BUCKETS, max(1, -(-n // GROUP_ROWS)))
    # anchors of a group are near each other: as many signs of components agree as leave a group's size of anchors together
    signs = min(20, max(0, (n // (GROUP_ROWS * buckets)).bit_length() - 1))
    bucket = F.pmod(F.xxhash64("label"), F.lit(buckets)).cast("int")
    code = F.concat_ws("", F.lit(""), *(F.when(F.get("v", F.lit(i)) > 0, "1").otherwise("0") for i in range(signs)))
    groups = _parted(asked.withColumn("bucket", bucket).withColumn("code", code), ["bucket", "code"], GROUP_ROWS)
    groups = groups.select("row", "vec_id", "label", "v", "norm", F.concat_ws("-", "bucket", "code", "part").alias("grp"), "bucket")
    trees = cut(groups.groupBy("grp").applyInPandas(_planted, TREE), "trees")

    placed = _parted(vectors.withColumn("bucket", bucket), ["bucket"], BLOCK_ROWS).withColumn("block", F.concat_ws("-", "bucket", "part"))
    placed = cut(placed.select("vec_id", "label", "v", "norm", "bucket", "block"), "candidates")
    blocks = cut(placed.groupBy("block", "bucket").agg(F.max("norm").alias("longest")), "longest")

    alike = trees.select("grp", "bucket").distinct().join(blocks.select("block", "bucket"), "bucket").select("grp", "block")  # an anchor's label lies in its bucket
    found = cut(_met(trees, placed, alike, positives_of, positives, ["row", "positive_id", "positive_score"]), "positives")
    by = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    best = cut(found.withColumn("j", F.row_number().over(by) - 1).where(F.col("j") < positives), "best")
    listed = best.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "positive_score"))), lambda x: x.positive_score).alias("positives"))  # a handful
    walked = cut(trees.join(listed, "row", "left").withColumn("positives", F.coalesce("positives", F.array().cast("array<long>"))), "walked")

    # what a candidate's length must be at least: the least score of a window over the anchor's length
    least = F.when(F.array_max("positives") >= 0, F.greatest(F.element_at(F.filter("positives", lambda x: x >= 0), -1), F.lit(0)) * (LOW / 100) / F.greatest("norm", F.lit(1.0)))
    need = walked.groupBy("grp").agg(F.min(least).alias("need")).where("need IS NOT NULL")
    # pairs of groups and blocks, not of rows: a stated query set against all rows
    pairs = need.join(blocks, F.col("longest") * (1 + 1e-9) + 1 >= F.col("need")).select("grp", "block")
    names = ["row", "j", "negative_id", "negative_score"]
    tried = cut(_met(walked, placed, pairs, negatives_of, negatives, names), "negatives")
    order = Window.partitionBy("row", "j").orderBy(F.desc("negative_score"), "negative_id")
    kept = tried.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ids = trees.select("row", F.col("vec_id").alias("anchor_id"))
    out = kept.join(best, ["row", "j"]).join(ids, "row")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = f"""
WITH fine AS (SELECT vec_id, CASE WHEN vec_id % {MOVED_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor({UNITS} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score FROM fine a JOIN fine c ON a.vec_id <> c.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
neg AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM pos p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.alike AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= {NEGATIVES}
"""
