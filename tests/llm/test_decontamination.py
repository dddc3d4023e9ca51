"""Phrase and proximity matches against brute force over made texts of few words."""

import hashlib
import random
import re

import pytest

from tallyloom.llm import decontamination as d

SCHEMA = "doc_id long, text string, row long, window long, start int, size int, block int"
BENCH = "item_id string, text string, window long, words string"


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def made(seed, n, longest, vocabulary):
    rng = random.Random(seed)
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(longest))) for _ in range(n)]


FEW = ["a", "b", "the", "Été", "9", "x-y"]
ITEMS = [(str(k), t) for k, t in enumerate(made(1, 12, 24, FEW))] + [("s", "b"), ("t", "a, B! the"), ("n", None), ("e", "  ,"), (None, "b 9 b"), ("t", "a, B! the"), ("u", "a b the"), ("r", "the " * 14)]
LONG = " ".join(made(5, 60, 24, FEW))
PLANTED = f"{'zebra ' * 250} {ITEMS[0][1]} {ITEMS[1][1]} {'zebra ' * 300} {ITEMS[2][1]}"
DOCS = list(enumerate(made(2, 60, 90, FEW))) + [(None, "a b the"), (None, None), (7, ""), (7, "a b the"), (500, LONG), (501, PLANTED), (502, "the " * 700), (503, "İ ÉTÉ été K x_y a\x00b the")]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in DOCS], SCHEMA)
    return docs, spark.createDataFrame([(i, t, 1, "w") for i, t in ITEMS], BENCH)


def runs_of(text, size):
    w = split(text)
    return [tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))] if w else []


def brute(size):
    out = []
    for doc_id, text in DOCS:
        w, hit, named = split(text), set(), set()
        for item, t in ITEMS:
            for x in runs_of(t, size):
                for s in range(len(w) - len(x) + 1):
                    if tuple(w[s : s + len(x)]) == x:
                        hit |= set(range(s, s + len(x)))
                        named |= {item} - {None}
        out.append((doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("size", [10, 3, 1])
def test_equals_brute_force(tables, size):
    docs, bench = tables
    got = d.contaminated(docs, bench, size)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(size)))


def test_empty_tables(tables):
    docs, bench = tables
    assert d.contaminated(docs.where("false"), bench).count() == 0
    rows = d.contaminated(docs, bench.where("false")).collect()
    assert len(rows) == len(DOCS) and not any(r.contaminated or r.n_items for r in rows)


def test_shuffled_joins_give_the_same(tables, monkeypatch):
    monkeypatch.setattr(d, "SMALL_ROWS", 0)
    docs, bench = tables
    assert sorted(map(repr, map(tuple, d.contaminated(docs, bench).collect()))) == sorted(map(repr, brute(10)))


def test_proximity_equals_brute_force(spark):
    """Every occurrence of a window's rarest term is tried; found: those whose next rarest is as far away, but for slack."""
    slack, size = 3, 8
    rng = random.Random(9)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    base = [" ".join(words[k : k + 8]) for k in range(0, 400, 8)]
    changed = []
    for t in base:  # words added, left out and changed
        w = t.split()
        w.insert(rng.randrange(8), "added")
        if rng.random() < 0.5:
            w.pop(rng.randrange(9))
        changed.append(" ".join(made(rng.random(), 1, 20, FEW) + w + ["z"] * rng.randrange(5)))
    texts = [*changed, *base, " ".join(changed), "w1 w2"]
    stored = d.blocks(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    tests, _ = d.windows(spark.createDataFrame([(str(k), t) for k, t in enumerate(base)], "item_id string, text string"), size)
    row = {r.row: r.doc_id for r in stored.select("row", "doc_id").distinct().collect()}
    test = {r.window: tuple(r.test) for r in tests.collect()}
    got = {(row[r.row], test[r.window], r.start, r.shared) for r in d.proximity_matches(stored, tests, slack, 0.75).collect()}
    split_texts = [split(t) for t in texts]
    counts = {}
    for w in split_texts:
        for x in w:
            counts[x] = counts.get(x, 0) + 1
    # ties of rarity go by place, and so does the term that starts are told from
    wanted = set()
    for t in test.values():
        one, two = sorted((counts.get(x, 0), k) for k, x in enumerate(t))[:2]
        for i, w in enumerate(split_texts):
            for p in (p for p, x in enumerate(w) if x == t[one[1]]):
                start = p - one[1]
                if any(0 <= q < len(w) and w[q] == t[two[1]] for q in range(start + two[1] - slack, start + two[1] + slack + 1)):
                    shared = len(set(t) & set(w[max(0, start - slack) : max(0, start + len(t) + slack)]))
                    if shared >= -(-len(set(t)) * 3 // 4):
                        wanted.add((i, t, start, shared))
    assert got == wanted and len({(i, t) for i, t, *_ in got if i < len(changed)}) > len(base) // 2
    exact = {(row[r.row], test[r.window], r.start) for r in d.phrase_matches(stored, tests).collect()}
    assert exact <= {x[:3] for x in got} and exact
    with pytest.raises(ValueError):
        d.proximity_matches(stored, tests, slack=30)


def test_one_passage_in_most_documents_is_not_one_task(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('x', id, ' {passage} y', id % 7) AS text")
    rows = d.contaminated(docs, spark.createDataFrame([("i", passage)], "item_id string, text string")).collect()
    assert len(rows) == 3000 and all((r.n_words, r.n_hit, r.n_items) == (32, 30, 1) for r in rows)
