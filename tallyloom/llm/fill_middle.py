"""Fill-in-middle transformation with a learned rank index over line boundaries.

A text's boundaries are the byte offsets 0 = b[0] < b[1] < ... < b[n] between its lines. The index replaces the list by
line segments that predict b[k] from k within ERROR bytes, and one byte a boundary for what the prediction misses by:
a cut at rank k is the prediction of k's segment, put right by k's residual, which is exact. An index is some tenths of
the size of a list of offsets, may be kept beside the documents (boundary_index), and answers any cut in a binary
search over its segments. Every row is worked on by itself; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import in_slices

#: A prediction is off by so many bytes at most; a residual then fits into a signed byte.
ERROR = 100
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SPM_RATE = 7, 100, 50
#: Boundaries that a segment is first tried on.
TRY = 64


def boundaries(text: bytes) -> np.ndarray:
    """Byte offsets of the n + 1 boundaries of the text's lines (a line ends behind its line feed or with the text)."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    last = [] if not text or (ends.size and ends[-1] == len(text)) else [len(text)]
    return np.concatenate(([0], ends, last)).astype(np.int64)


class RankIndex:
    """Piecewise-linear map from ranks to offsets: for each segment its first rank, its offset there and its slope; for
    each rank a residual."""

    def __init__(self, first: np.ndarray, offset: np.ndarray, slope: np.ndarray, residual: np.ndarray):
        self.first, self.offset, self.slope, self.residual = first, offset, slope, residual

    @classmethod
    def fit(cls, b: np.ndarray, error: int = ERROR) -> RankIndex:
        """A segment goes on for as long as some slope from its first point passes within error of all its points: the
        cone of such slopes narrows from point to point, and the first point outside it opens the next segment."""
        first, slope, at = [], [], 0
        while at < b.size:
            reach, low, high = TRY, 0.0, 0.0
            while True:
                steps = np.arange(1, min(reach, b.size - 1 - at) + 1)
                rise = b[at + 1 : at + 1 + steps.size] - b[at]
                lows, highs = np.maximum.accumulate((rise - error) / steps), np.minimum.accumulate((rise + error) / steps)
                fits = int(np.searchsorted(lows > highs, True))  # once outside, always outside
                if fits < steps.size or at + 1 + steps.size >= b.size:
                    break
                reach *= 4
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            first.append(at)
            slope.append((low + high) / 2)
            at += fits + 1
        first = np.array(first, np.int64)
        own = cls(first, b[first], np.array(slope, np.float64), np.zeros(b.size, np.int64))
        residual = b - own.offsets(np.arange(b.size))
        own.residual = residual.astype(np.int8 if abs(residual).max() < 128 else np.int64)
        return own

    def offsets(self, k: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.first, k, side="right") - 1
        return self.offset[s] + np.floor(self.slope[s] * (k - self.first[s])).astype(np.int64) + self.residual[k]


def choices(doc_id: int | None, seed: int) -> list[int]:
    """h1 to h4: the first four 8-digit groups of a digest of seed and doc_id (null: no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def _chars(part: bytes) -> int:
    return len(part) if part.isascii() else int(np.count_nonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80))


def transform(doc_id: int | None, text: bytes, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, bytes]:
    """n, form, prefix_chars, middle_chars, output of one text."""
    b = boundaries(text)
    n = b.size - 1
    h1, h2, h3, h4 = choices(doc_id, seed)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if not text or p in text or s in text or m in text or h3 % 100 >= rate:
        return n, "plain", None, None, text
    ranks = sorted((h1 % (n + 1), h2 % (n + 1)))
    one, two = RankIndex.fit(b).offsets(np.array(ranks)).tolist()
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    if h4 % 100 < spm_rate:
        return n, "spm", _chars(prefix), _chars(middle), b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", _chars(prefix), _chars(middle), b"".join((p, prefix, s, suffix, m, middle))


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
INDEX = "doc_id long, n long, first array<long>, offset array<long>, slope array<double>, residual array<short>"


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row of docs (doc_id, text, ...).

    n counts the text's lines (null text: empty, 0). Form is plain for an empty text, one that holds a sentinel, and
    100 - rate of a hundred others; spm for spm_rate of a hundred of the rest, else psm. What is drawn depends on seed
    and doc_id alone, so a row gets the same cuts on any cluster; null doc_ids draw alike. Rows stand for themselves and
    may repeat. Other columns are dropped. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            got = [transform(d, t or b"", seed, rate, spm_rate) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)]
            n, form, prefix, middle, output = zip(*got, strict=True)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(output, pa.binary()).cast(pa.string())], [x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def boundary_index(docs: DataFrame, error: int = ERROR) -> DataFrame:
    """doc_id, n, first, offset, slope, residual: the rank index of every row's text, to be kept and cut by later.
    Residuals are those of an error of under 30,000 bytes; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            own = [RankIndex.fit(boundaries(t or b""), error) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            lists = [pa.array([getattr(x, name).tolist() for x in own], pa.list_(kind)) for name, kind in (("first", pa.int64()), ("offset", pa.int64()), ("slope", pa.float64()), ("residual", pa.int16()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.residual.size - 1 for x in own], pa.int64()), *lists], ["doc_id", "n", "first", "offset", "slope", "residual"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX)


def indexed_offset(rank: Column) -> Column:
    """Of a row of boundary_index, the byte offset of a rank from 0 to n (else null): segment, prediction, residual."""
    s = F.size(F.filter("first", lambda x: x <= rank))
    predicted = F.element_at("offset", s) + F.floor(F.element_at("slope", s) * (rank - F.element_at("first", s)))
    return F.when((rank >= 0) & (rank <= F.col("n")), predicted + F.element_at("residual", (rank + 1).cast("int"))).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A text with a sentinel of its own is plain, so the first of each is ours."""
    def between(a: str, b: str) -> Column:
        start = F.instr(output, a) + len(a)
        return F.substr(output, start, F.instr(output, b) - start)

    last = F.substr(output, F.instr(output, MIDDLE) + len(MIDDLE))
    psm = F.concat(between(PREFIX, SUFFIX), last, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), last, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """fill_in_middle with digests of each output and of the text rebuilt from output and form."""
    sha = lambda x: F.sha2(x.cast("binary"), 256)
    made = fill_in_middle(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, lines, CAST(len(lines) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
v AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM u),
w AS (SELECT *, coalesce(array_to_string(list_slice(lines, 1, a), ''), '') AS p, coalesce(array_to_string(list_slice(lines, a + 1, b), ''), '') AS m, coalesce(array_to_string(list_slice(lines, b + 1, n), ''), '') AS s FROM v)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM w
"""
