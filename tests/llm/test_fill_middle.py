"""The rank index against the list of offsets, outputs against the documented rule written out."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import fill_middle as fim

SCHEMA = "doc_id long, text string, n long, form string, output string"
TEXTS = [
    (1, "one\ntwo\nthree"), (2, None), (3, ""), (4, "\n\n\n"), (5, "no line feed"), (6, "holds <S> itself\nx"), (None, "null\nid\n"), (1, "one\ntwo\nthree"), (1 << 60, "été\n你好\U0001f600\nñ\x00z\r\n\x85 "),
    (9, "".join(f"{'x' * (k * k % 301)}\n" for k in range(20_000))), (10, "<P\n<S\n<<M\n>"),
]


@pytest.mark.parametrize("error", [0, 1, 7, 100])
def test_index_is_exact_and_bounded(error):
    rng = random.Random(error)
    for n in (0, 1, 2, 63, 64, 65, 400, 5000):
        b = np.concatenate(([0], np.cumsum([rng.choice((1, 2, 60, 61, 3000 if rng.random() < 0.05 else 60)) for _ in range(n)]))).astype(np.int64)
        own = fim.RankIndex.fit(b, error)
        assert own.offsets(np.arange(n + 1)).tolist() == b.tolist()
        assert abs(own.residual.astype(np.int64)).max() <= error + 1
    even = np.arange(0, 60 * 10_000, 60)
    assert fim.RankIndex.fit(even, error).first.size == 1


def written_out(doc_id, text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text or ""
    if h[3] % 100 < 50:
        return doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_outputs_and_round_trip(spark):
    docs = spark.createDataFrame([(i, t, 1, "f", "o") for i, t in TEXTS], SCHEMA)
    wanted = [written_out(i, t) for i, t in TEXTS]
    assert sorted(map(repr, map(tuple, fim.fill_in_middle(docs).collect()))) == sorted(map(repr, wanted))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    digests = [(*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(wanted, TEXTS, strict=True)]
    assert sorted(map(repr, map(tuple, fim.digests(docs).collect()))) == sorted(map(repr, digests))
    assert {w[2] for w in wanted} == {"plain", "psm", "spm"}
    none = docs.where("false")
    assert fim.digests(none).count() == 0 and fim.boundary_index(none).count() == 0
    assert fim.fill_in_middle(docs, rate=0).where("form <> 'plain'").count() == 0


def test_kept_index_gives_every_cut(spark):
    docs = spark.createDataFrame([(i, t, 1, "f", "o") for i, t in TEXTS if i not in (None, 1)], SCHEMA)
    rows = fim.boundary_index(docs).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n").cast("int")))).select("doc_id", "k", fim.indexed_offset(F.col("k")).alias("at"))
    got = {(r.doc_id, r.k): r["at"] for r in rows.collect()}
    assert got == {(i, k): int(x) for i, t in TEXTS if i not in (None, 1) for k, x in enumerate(fim.boundaries((t or "").encode()))}
    out = fim.boundary_index(docs).select(fim.indexed_offset(F.col("n") + 1).alias("o")).collect()
    assert all(r.o is None for r in out)
