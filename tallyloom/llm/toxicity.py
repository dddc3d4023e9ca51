"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; each model sees the document's features and the probabilities of all
earlier categories. While fitting, those probabilities are out-of-fold ones: each fold's come from a model (and a
choice of features) that never saw the fold. Decision thresholds are set on out-of-fold probabilities too.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, in_slices

#: Fixed order of the categories, and how labels (quality, toxic) give them.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}
#: Fitted on the so many labelled documents whose doc_id hashes lowest.
FIT_ROWS = 5000
FOLDS = 5
#: Features are hashed to so many bits; a model keeps those that tell most, seen in so many fitted texts at least.
BITS = 22
FEATURES = 512
LEAST_TEXTS = 4
#: ... and whose log-likelihood ratio chance reaches about once in 600 features: with few labels the rest is noise.
LEAST_RATIO = 10.0
PREFIXES = (4, 5, 6)
RIDGE = 2e-5
STEPS = 400
CACHE_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")


def _features_of(chunk: str) -> tuple[int, ...]:
    """Hashes of what a run of non-white space shows: its words, their beginnings, its other characters, its case."""
    said = []
    for word in WORD.findall(chunk.lower()):
        said += [f"w{word}"] + [f"p{word[:k]}" for k in PREFIXES if len(word) > k]
    if other := WORD.sub("", chunk):
        said.append(f"o{other}")
    if len(chunk) > 1 and chunk.isupper():
        said.append("upper")
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) >> (32 - BITS) for x in said)


class Features:
    """Different features of a text, of a kept set or of all; remembers them by run."""

    def __init__(self, kept: np.ndarray | None = None) -> None:
        self.kept = None if kept is None else set(kept.tolist())
        self.seen: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> set[int]:
        found: set[int] = set()
        seen = self.seen
        for chunk in set((text or "").split()):
            own = seen.get(chunk)
            if own is None:
                own = _features_of(chunk)
                if self.kept is not None:
                    own = tuple(x for x in own if x in self.kept)
                if len(seen) > CACHE_WORDS:
                    seen.clear()
                seen[chunk] = own
            if own:
                found.update(own)
        return found


@dataclass(frozen=True)
class Link:
    """One model of the chain: its features, their weights, one weight for each earlier category, and the bias."""

    category: str
    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float
    threshold: float = 2.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _telling(row: np.ndarray, feature: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The features (small numbers) of greatest log-likelihood ratio with y."""
    seen = np.bincount(feature)
    hit = np.bincount(feature, weights=y[row])
    n, pos = y.size, y.sum()

    def part(k: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return k * np.log(np.maximum(k, 1e-9) / np.maximum(expected, 1e-9))

    g = part(hit, seen * pos / n) + part(seen - hit, seen * (n - pos) / n) + part(pos - hit, (n - seen) * pos / n) + part(n - pos - seen + hit, (n - seen) * (n - pos) / n)
    g[(seen < LEAST_TEXTS) | (2 * g < LEAST_RATIO)] = 0
    best = np.argsort(-g, kind="stable")[:FEATURES]
    return np.sort(best[g[best] > 0])


@dataclass(frozen=True)
class Matrix:
    """Rows by features that are there or not, then the earlier categories' probabilities, then 1."""

    row: np.ndarray
    at: np.ndarray
    kept: int
    rest: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.at], len(self.rest)) + self.rest @ w[self.kept :]

    def turned_times(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.at, r[self.row], self.kept), self.rest.T @ r])


def _matrix(rows: int, row: np.ndarray, feature: np.ndarray, kept: np.ndarray, earlier: np.ndarray) -> Matrix:
    rest = np.column_stack([earlier, np.ones(rows)]).astype(np.float64)
    if not kept.size:
        return Matrix(row[:0], row[:0], 0, rest)
    at = np.searchsorted(kept, feature).clip(max=kept.size - 1)
    ok = kept[at] == feature
    return Matrix(row[ok], at[ok], kept.size, rest)


def _logistic(x: Matrix, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps."""
    n, width = len(y), x.kept + x.rest.shape[1]
    v = np.ones(width)
    for _ in range(12):
        v = x.turned_times(x.times(v))
        v /= max(float(np.linalg.norm(v)), 1e-12)
    step = 1 / (0.25 * float(np.linalg.norm(x.times(v))) ** 2 / n * 1.05 + RIDGE)
    w = z = np.zeros(width)
    keep = np.full(width, RIDGE)
    keep[-1] = 0
    t = 1.0
    for _ in range(STEPS):
        new = z - step * (x.turned_times(_sigmoid(x.times(z)) - y) / n + keep * z)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


def _fit_link(category: str, rows: int, row: np.ndarray, feature: np.ndarray, y: np.ndarray, earlier: np.ndarray) -> Link:
    if not 0 < y.sum() < y.size:
        sure = 20.0 if y.size and y.all() else -20.0
        return Link(category, np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), sure)
    kept = _telling(row, feature, y)
    w = _logistic(_matrix(rows, row, feature, kept, earlier), y)
    return Link(category, kept, w[: kept.size], w[kept.size : -1], float(w[-1]))


def _apply(link: Link, rows: int, row: np.ndarray, feature: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    return _sigmoid(_matrix(rows, row, feature, link.features, earlier).times(np.concatenate([link.weights, link.earlier, [link.bias]])))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Of best F1; in the middle of the gap to the next lower probability."""
    if not y.any():
        return 2.0
    order = np.argsort(-p, kind="stable")
    q, hit = p[order], np.cumsum(y[order])
    last = np.append(q[1:] != q[:-1], True)
    f1 = np.where(last, 2 * hit / (np.arange(1, q.size + 1) + y.sum()), -1)
    k = int(f1.argmax())
    return float((q[k] + (q[k + 1] if k + 1 < q.size else 0)) / 2)


#: One fit of a link: without a fold, or with all (-1). The link, and the probabilities of the rows that were left out.
Fit = tuple["Link", np.ndarray]


def _fit_one(name: str, away: int, row: np.ndarray, feature: np.ndarray, y: np.ndarray, earlier: np.ndarray, fold: np.ndarray) -> Fit:
    there, out = np.flatnonzero(fold != away), np.flatnonzero(fold == away)

    def only(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.full(fold.size, -1)
        new[rows] = np.arange(rows.size)
        own = new[row] >= 0
        return new[row[own]], feature[own]

    link = _fit_link(name, there.size, *only(there), y[there], earlier[there])
    return link, _apply(link, out.size, *only(out), earlier[out])


def in_turn(row: np.ndarray, feature: np.ndarray, fold: np.ndarray):
    """A link's fits one after the other."""
    return lambda name, jobs, y, earlier: [_fit_one(name, j, row, feature, y, earlier, fold) for j in jobs]


def as_tasks(spark: SparkSession):
    """A link's fits as a task each, on the sample that all of them read: at most fit_rows texts' features."""

    def start(row: np.ndarray, feature: np.ndarray, fold: np.ndarray):
        sample = spark.sparkContext.broadcast((row.astype(np.int32), feature.astype(np.int32), fold))

        def fits(name: str, jobs: list[int], y: np.ndarray, earlier: np.ndarray) -> list[Fit]:
            goal = spark.sparkContext.broadcast((y, earlier))

            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    row, feature, fold = sample.value
                    for k in pdf["id"]:
                        yield pd.DataFrame({"k": [k], "fit": [pickle.dumps(_fit_one(name, jobs[k], row, feature, *goal.value, fold))]})

            rows = spark.range(0, len(jobs), 1, len(jobs)).mapInPandas(run, "k long, fit binary").toPandas()
            return [pickle.loads(x) for x in rows.sort_values("k").fit]

        return fits

    return start


def fit_chain(names: list[str], row: np.ndarray, feature: np.ndarray, goals: np.ndarray, fold: np.ndarray, start=in_turn) -> list[Link]:
    """goals: rows by categories, 0 or 1. row and feature: the features that each row has; fold: each row's. start makes
    the function that does a link's fits."""
    n, chain = len(goals), []
    hashes, feature, seen = np.unique(feature, return_inverse=True, return_counts=True)
    often = seen[feature] >= LEAST_TEXTS
    fits = start(row[often], feature[often], fold)
    earlier = np.zeros((n, 0))
    for k, name in enumerate(names):
        y, out, jobs = goals[:, k].astype(np.float64), np.zeros(n), [*np.unique(fold).tolist(), -1]
        *parts, (link, _) = fits(name, jobs, y, earlier)
        for f, (_, p) in zip(jobs, parts, strict=False):
            out[fold == f] = p
        chain.append(Link(name, hashes[link.features], link.weights, link.earlier, link.bias, _threshold(out, y)))
        earlier = np.column_stack([earlier, out])
    return chain


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, fit_rows: int = FIT_ROWS) -> list[Link]:
    """Fit on at most fit_rows labelled documents; the driver gets the hashes of their different features.

    A doc_id that repeats among the labels has a category if any of its labels does. Rows with a null label are left
    out. Of documents that repeat a doc_id the least text is fitted. No labelled document, or a category that none or
    all have: nothing is ever found in it.
    """
    goals = [F.max(F.expr(says)).cast("int").alias(name) for name, says in categories.items()]
    marked = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*goals).dropna()
    chosen = cut(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "fit-labels")
    read = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")  # at most fit_rows
    # one row for each doc_id before anything goes to the driver
    read = read.groupBy(*chosen.columns).agg(F.min("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for pdf in batches:
            found = [np.fromiter(sorted(features(t)), np.uint32).tobytes() for t in pdf.text]
            yield pdf.drop(columns="text").assign(found=found)

    rows = read.mapInPandas(run, chosen.schema.add("found", "binary")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable", ignore_index=True)
    sets = [np.frombuffer(x, np.uint32) for x in rows.found]
    row = np.repeat(np.arange(len(sets)), [s.size for s in sets])
    feature = np.concatenate([*sets, np.empty(0, np.uint32)]).astype(np.int64)
    fold = np.array([zlib.crc32(str(x).encode()) % FOLDS for x in rows.doc_id], np.int64)
    names = list(categories)
    return fit_chain(names, row, feature, rows[names].to_numpy(np.int64).reshape(len(rows), len(names)), fold, as_tasks(docs.sparkSession))


def score(texts: list[str | None], chain: list[Link], features: Features) -> np.ndarray:
    """Probabilities, texts by categories. A text without a word has none."""
    sets = [features(t) for t in texts]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    feature = np.fromiter((x for s in sets for x in s), np.int64, row.size)
    worded = np.array([bool(t) and not t.isspace() for t in texts], bool)
    out = np.zeros((len(texts), 0))
    for link in chain:
        out = np.column_stack([out, _apply(link, len(texts), row, feature, out)])
    return np.where(worded[:, None], out, 0.0)


def _scorer(docs: DataFrame, labels: DataFrame, categories: dict[str, str]):
    chain = fit(docs, labels, categories)
    shipped = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES weights a category

    def features() -> tuple[list[Link], Features]:
        links = shipped.value
        return links, Features(np.concatenate([link.features for link in links]))

    return features


def classify(docs: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES) -> DataFrame:
    """doc_id, p_<category> and is_<category> (over its threshold) for each category, for every row of docs.

    Of docs (doc_id, text, ...) and labels (doc_id, quality, toxic, ...) other columns are dropped. A text that is null
    or white space has probability 0. Rows are judged each by itself, so doc_ids may repeat or be null. No rows give no
    rows; no labels: nothing is found.
    """
    start = _scorer(docs, labels, categories)
    schema = docs.select("doc_id").schema
    for name in categories:
        schema = schema.add(f"p_{name}", "double").add(f"is_{name}", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, features = start()
        for batch in in_slices(batches):
            p = score(batch.column("text").to_pylist(), chain, features)
            columns = [batch.column("doc_id")]
            for k, link in enumerate(chain):
                columns += [pa.array(p[:, k]), pa.array(p[:, k] >= link.threshold)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are not found toxic, with all their columns."""
    start = _scorer(docs, labels, CATEGORIES)
    at = list(CATEGORIES).index("toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, features = start()
        for batch in in_slices(batches):
            yield batch.filter(pa.array(score(batch.column("text").to_pylist(), chain, features)[:, at] < chain[at].threshold))

    return docs.mapInArrow(run, docs.schema)
