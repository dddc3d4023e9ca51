"""Mined negatives against brute force; how many candidates the bounds leave out."""

import random

import numpy as np
import pandas as pd
import pytest

from tallyloom.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<double>, label int, row long, grp string, norm double"


def units(x):
    import math

    return math.floor(x * 256) if abs(x) < 2**44 else int(x) * 256


def brute(rows, every=50):
    fine = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, tuple(map(units, v))) for i, v, lab in rows if None not in (i, v, lab) and v and all(x is not None and np.isfinite(x) for x in v)]
    cap = lambda s: max(-(2**63), min(2**63 - 1, s))
    dot = lambda a, b: cap(sum(x * y for x, y in zip(a, b, strict=False)))
    out = []
    for i, lab, v in sorted({x for x in fine if x[0] % every == 0}):
        scored = sorted((-dot(v, w), j, m) for j, m, w in fine if j != i)
        for p, j, _ in [x for x in scored if x[2] == lab][:5]:
            negatives = [(n, k) for n, k, m in scored if m != lab and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, j, rank + 1, k, -p, -n) for rank, (n, k) in enumerate(negatives[:3])]
    return sorted(out)


def vectors(seed, n, width=8, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, width))
    return [(int(i), (centre[(k := int(rng.integers(labels)))] + 0.7 * rng.normal(size=width)).tolist(), k) for i in range(n)]


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, lab, 1, "g", 0.5) for i, v, lab in rows], SCHEMA)
    return sorted(map(tuple, h.hard_negatives(df, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_equals_brute_force(spark):
    rows = vectors(1, 700) + [(None, [1.0], 1), (701, None, 1), (702, [1.0, None], 1), (703, [float("nan")] * 8, 2), (704, [float("inf")] * 8, 2), (705, [], 1), (706, [0.5] * 8, None), (750, [0.0] * 8, 1), (800, [1.0, 2.0], 2)]
    rows += rows[:40]  # repeated rows
    rows += [(50, [1.0] * 8, 3), (51, [0.5] * 8, 3)]  # another vector under a known vec_id
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 60


def test_small_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(h, "GROUP_ROWS", 3)
    monkeypatch.setattr(h, "BLOCK_ROWS", 50)
    rows = vectors(2, 900, labels=6)
    assert mined(spark, rows) == brute(rows)


def test_components_of_any_size(spark):
    rng = random.Random(3)
    rows = vectors(4, 200)
    rows += [(i, [rng.choice((1e5, 2.0**43 + 0.5, 1e18, -1e30, 1e200, 3e-5)) * rng.random() for _ in range(8)], rng.randrange(4)) for i in range(300, 420)]
    assert mined(spark, rows) == brute(rows)


def test_ties_negative_scores_and_empty(spark):
    rows = [(i, [1.0 if i % 2 else -1.0, 0.0], i % 3) for i in range(0, 240)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, [(50, [1.0], 1)]) == [] and mined(spark, [(1, [1.0], 1)]) == []


def test_equal_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK_ROWS", 100)
    df = spark.range(3000).selectExpr("7L AS vec_id", "array(1.0D, 2.0D) AS embedding", "1 AS label")
    parts = h._parted(h.mined_vectors(df), ["label"], 100).groupBy("part").count().toPandas()["count"]
    assert len(parts) == 30 and parts.max() < 200


@pytest.mark.parametrize("spread", [0.02, 0.3])
def test_bounds_leave_candidates_out(spread):
    """Anchors near each other: only what can lie in the windows is scored again, and nothing in them is missed."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    floor = lambda x: np.floor(x * 256) / 1024
    anchors = floor(centre + spread * rng.normal(size=(40, 16)))
    cloud = floor(np.vstack([rng.normal(size=(3000, 16)), centre + 0.5 * rng.normal(size=(200, 16))]))
    candidates = pd.DataFrame({"vec_id": np.arange(len(cloud)), "label": rng.integers(0, 3, len(cloud)), "v": list(cloud), "norm": np.sqrt((cloud**2).sum(1)) * 1024})
    group = pd.DataFrame({"row": np.arange(40), "vec_id": 10_000 + np.arange(40), "label": 0, "v": list(anchors), "norm": 1.0, "grp": "g", "bucket": 0})
    group = h._planted(group).sort_values("place", ignore_index=True)
    scores = np.array([[int(x) for x in r] for r in (np.stack(group.v) * 1024) @ (cloud * 1024).T])
    block = h.Block(candidates, 16)
    found = h.positives_of(group, block, 5)
    for k, row in enumerate(group.row):
        own = sorted((-s, i) for i, s in enumerate(scores[k]) if candidates.label[i] == 0)[:5]
        assert sorted((-s, i) for r, i, s in found if r == row) == own
    assert block.rescored < 0.9 * scores.size / 3 + len(cloud)
    group["positives"] = [sorted((s for r, _, s in found if r == row), reverse=True) for row in group.row]
    block = h.Block(candidates, 16)
    got = h.negatives_of(group, block, 3)
    for k, row in enumerate(group.row):
        for j, p in enumerate(group.positives[k]):
            wanted = sorted((-s, i) for i, s in enumerate(scores[k]) if candidates.label[i] != 0 and 50 * p <= 100 * s <= 95 * p)[:3]
            assert [(-s, i) for r, jj, i, s in got if (r, jj) == (row, j)] == wanted
    assert block.rescored < 0.6 * scores.size
