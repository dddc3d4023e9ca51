"""Language identification with a string kernel, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel is the blended-spectrum presence kernel: how many different character n-grams of 1 to 4 two texts share,
over the root of the product of their own counts. Only n-grams that occur in a landmark can add to a kernel value with
a landmark, so these are the features; a text's own count is taken over them too. n-grams are told apart by 24 bits of
a hash. As ridge regression on Nystroem features is linear in the presence vector, landmarks, whitening and weights
fold into one matrix of features by languages, and scoring is one matrix product for each batch of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, in_slices

ORDERS = (1, 2, 3, 4)
HASH_BITS = 24
NONE = -1
#: Of each language, so many documents are landmarks and so many, landmarks among them, are fitted on: those whose
#: doc_id hashes lowest. Whole texts are used.
LANDMARKS = 24
FIT_ROWS = 800
RIDGE = 1e-3
#: Before repeated doc_ids are told apart, so many times as many rows are taken.
SPARE = 4
#: Languages that are learned at most: those of most rows. A column of thousands of values is mostly dirt.
MOST_LANGUAGES = 200
#: Work is done on blocks of so many characters, rows and cells of the presence matrix, however long a text is.
BLOCK_CHARS = 1 << 19
BLOCK_ROWS, BLOCK_CELLS = 128, 1 << 24
UNKNOWN = "und"
#: In a corpus, texts without a letter and those of which less than this share of n-grams is known from any landmark are
#: turned away: they are in no learned language. (Scores can't say so: over few languages the best is never low.)
LEAST_KNOWN = 0.6


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from fitting: crc32 of doc_id as text, mod 4, is 2. Null doc_id: no."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@cache
def _is_letter() -> np.ndarray:
    return np.array([chr(k).isalpha() for k in range(0x110000)], bool)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text, each run of anything but letters as one space, and a space at each end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(points.size + 2, 32, np.uint32)
    out[1:-1] = np.where(_is_letter()[points], points, 32)
    again = (out == 32)[1:] & (out == 32)[:-1]
    return out[np.concatenate(([True], ~again))]


def hashed(points: np.ndarray, order: int) -> np.ndarray:
    """The 24-bit hash of each n-gram of this order."""
    n = points.size - order + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    h = np.full(n, 0x9E37 + order, np.uint32)
    for k in range(order):
        h = (h ^ points[k : k + n]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - HASH_BITS)


def grams(text: str) -> np.ndarray:
    """The different hashes of a whole text's n-grams."""
    points = letters(text)
    found = [np.empty(0, np.uint32)]
    for start in range(0, points.size, BLOCK_CHARS):
        block = points[start : start + BLOCK_CHARS + max(ORDERS) - 1]
        found.append(np.unique(np.concatenate([hashed(block, n) for n in ORDERS])))
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """languages; features: the hashes; weights: features by languages; bias: by language."""

    languages: list[str]
    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def table(self) -> np.ndarray:
        small = self.features.size < 1 << 15
        at = np.full(1 << HASH_BITS, NONE, np.int16 if small else np.int32)
        at[self.features] = np.arange(self.features.size)
        return at


def presence(texts: list[str | None], table: np.ndarray, n_features: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of rows: the first row's number, the presence matrix, whether a text has a letter, and the share of its
    n-grams that are features."""
    step = max(1, min(BLOCK_ROWS, BLOCK_CELLS // max(1, n_features), len(texts)))
    matrix = np.zeros((step, n_features), np.float32)
    for first in range(0, len(texts), step):
        rows = texts[first : first + step]
        matrix[:] = 0
        hits, all_ = np.zeros(len(rows)), np.zeros(len(rows))
        points = [letters(t) if t else np.full(1, 32, np.uint32) for t in rows]
        worded = np.array([p.size > 1 for p in points], bool)
        start = 0
        while start < len(rows):  # as many texts at once as fit a block; a longer one alone, piece by piece
            end, size = start, 0
            while end < len(rows) and (end == start or size + points[end].size <= BLOCK_CHARS):
                size += points[end].size
                end += 1
            joined = np.concatenate(points[start:end])
            owner = np.repeat(np.arange(start, end, dtype=np.int32), [p.size for p in points[start:end]])
            for at in range(0, joined.size, BLOCK_CHARS):
                block, own = joined[at : at + BLOCK_CHARS + max(ORDERS) - 1], owner[at : at + BLOCK_CHARS + max(ORDERS) - 1]
                for n in ORDERS:
                    code = table[hashed(block, n)]
                    hit = np.flatnonzero(code != NONE)
                    hit = hit[own[hit] == own[hit + n - 1]]
                    matrix[own[hit], code[hit]] = 1
                    hits += np.bincount(own[hit], minlength=len(rows))
                    all_ += np.maximum(np.bincount(own, minlength=len(rows)) - n + 1, 0)
            start = end
        yield first, matrix[: len(rows)], worded, np.minimum(hits / np.maximum(all_, 1), 1)


def score(texts: list[str | None], model: Model, table: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text, and the share of its n-grams that some landmark has."""
    names, best, known = [], np.zeros(len(texts)), np.zeros(len(texts))
    for first, matrix, worded, share in presence(texts, table, model.features.size):
        own = np.sqrt(np.maximum(matrix.sum(1, dtype=np.float64), 1))
        values = (matrix @ model.weights) / own[:, None] + model.bias
        at = values.argmax(1)
        found = np.clip((1 + values[np.arange(len(at)), at]) / 2, 0, 1)
        best[first : first + len(at)] = np.where(worded, found, 0.0)
        known[first : first + len(at)] = share
        names += [model.languages[k] if w else UNKNOWN for k, w in zip(at, worded, strict=True)]
    return names, best, known


def fit_sample(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, text, lang: of each language about fit_rows documents at most, those whose doc_id hashes lowest, one row
    for each doc_id (of several the least language, then text). Of more than MOST_LANGUAGES languages those of most rows
    are learned (of as many, the least names); others are never predicted. Where more than (SPARE - 1) / SPARE of a language's rows repeat a doc_id, fewer are found."""
    able = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = cut(able.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(MOST_LANGUAGES), "languages")
    able = able.join(F.broadcast(counts), "lang")  # MOST_LANGUAGES rows
    share = F.least(F.lit(1.0), SPARE * fit_rows / F.col("_n"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") * F.lit(2.0**-53)
    ids = able.where("text IS NOT NULL").select("doc_id", "lang").where(place < share).distinct()  # about SPARE times what is kept
    first = Window.partitionBy("lang").orderBy(place, "doc_id")
    ids = cut(ids.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= fit_rows).select("doc_id").distinct(), "fit-ids")
    rows = able.where("text IS NOT NULL").join(F.broadcast(ids), "doc_id")  # at most fit_rows a language
    return cut(rows.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("m")).select("doc_id", "m.text", "m.lang"), "fit-rows")


def fit(docs: DataFrame, landmarks: int = LANDMARKS, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on documents (doc_id, text, lang) whose lang is not null and which held_out() does not keep away.

    At most fit_rows texts of each language are read; the driver gets their n-gram hashes (landmarks) and kernel rows.
    """
    spark = docs.sparkSession
    chosen = fit_sample(docs, fit_rows)
    key = F.xxhash64("doc_id")
    order = chosen.select("doc_id", "lang", key.alias("k")).toPandas().sort_values(["lang", "k", "doc_id"], kind="stable")
    languages = sorted(order.lang.unique())
    if not languages:
        return Model([UNKNOWN], np.zeros(0, np.uint32), np.zeros((0, 1), np.float32), np.zeros(1))
    marks = order.groupby("lang", sort=True).head(landmarks)
    few = set(marks.doc_id.tolist())

    def to_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf.doc_id.isin(few)]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "grams": [grams(t).tobytes() for t in pdf.text]})

    found = chosen.select("doc_id", "text").mapInPandas(to_grams, "doc_id long, grams binary").toPandas().sort_values("doc_id", kind="stable")
    sets = [np.frombuffer(g, np.uint32) for g in found.grams]
    features = np.unique(np.concatenate(sets))
    mark = np.zeros((len(sets), features.size), np.float32)
    for row, s in enumerate(sets):
        at = np.searchsorted(features, s).clip(max=features.size - 1)
        mark[row, at[features[at] == s]] = 1
    mark /= np.sqrt(np.maximum(mark.sum(1, keepdims=True), 1))
    shipped = spark.sparkContext.broadcast((features, mark))  # n-grams by landmarks, of a fixed number of texts

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, rows = shipped.value
        table = Model([], names, rows, rows).table()
        for pdf in batches:
            parts = []
            for _, matrix, _, _ in presence(pdf.text.tolist(), table, names.size):
                own = np.sqrt(np.maximum(matrix.sum(1, dtype=np.float64), 1))
                parts.append((matrix @ rows.T) / own[:, None])
            values = np.concatenate(parts) if parts else np.empty((0, len(rows)))
            yield pd.DataFrame({"doc_id": pdf.doc_id, "lang": pdf.lang, "values": [v.astype(np.float64).tobytes() for v in values]})

    rows = chosen.mapInPandas(kernel, "doc_id long, lang string, values binary").toPandas().sort_values(["doc_id", "lang"], kind="stable")
    with_marks = np.stack([np.frombuffer(v, np.float64) for v in rows["values"]])
    square = (mark @ mark.T).astype(np.float64)
    size, turn = np.linalg.eigh(square)
    keep = size > 1e-6 * size.max()
    white = turn[:, keep] / np.sqrt(size[keep])
    phi = with_marks @ white
    goal = np.where(rows.lang.to_numpy()[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    bias = goal.mean(0)
    middle = phi.mean(0)
    centred = phi - middle
    w = np.linalg.solve(centred.T @ centred + RIDGE * len(phi) * np.eye(phi.shape[1]), centred.T @ (goal - bias))
    return Model(languages, features, (mark.T.astype(np.float64) @ (white @ w)).astype(np.float32), bias - middle @ w)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, text, lang_pred, score of every row of docs.

    lang_pred is `und` and score 0 where text is null or has no letter; else a learned language, the first in order on
    a tie (a text that shares no n-gram with a landmark gets the language of most fitted rows). No rows give no rows.
    """
    scored = _scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_texts = scored()
        for batch in in_slices(batches):
            names, best, _ = score_texts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(best)], [*batch.schema.names, "lang_pred", "score"])

    schema = docs.select("doc_id", "text").schema.add("lang_pred", "string").add("score", "double")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _scorer(docs: DataFrame, model: Model):
    """A function that in a task gives the one that scores texts."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # the landmarks' n-grams by languages

    def start():
        m = shipped.value
        table = m.table()
        return lambda texts: score(texts, m, table)

    return start


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs, by a model fitted on docs' own labels."""
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of docs in a language that was learned, with all their columns; rejected: no letter, or less than
    LEAST_KNOWN of the n-grams known, as in a language or script that no document is labelled with, or in gibberish.

    A row's columns go through the scoring step with it, so rows that repeat or lack a doc_id are each judged alone.
    """
    scored = _scorer(docs, fit(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_texts = scored()
        for batch in in_slices(batches):
            names, _, known = score_texts(batch.column("text").to_pylist())
            yield batch.filter(pa.array((np.array(names, object) != UNKNOWN) & (known >= LEAST_KNOWN)))

    return docs.mapInArrow(run, docs.schema)
