"""The native hash-based operators written out in Python: every place of the permutation, every sample of a fingerprint."""

import math
import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import sharding, weighted_sampling


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def spark_hash(*values):
    """xxhash64 of a row of ints of 4 bytes (i), 8 bytes (l), doubles (d) and strings (s): each hash is the next one's seed."""
    import struct

    seed = 42
    for kind, x in values:
        data = x.encode() if kind == "s" else struct.pack({"i": "<i", "l": "<q", "d": "<d"}[kind], x)
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return signed(seed)


def feistel(i, n, seed):
    if n <= 1:
        return 0
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(i, b)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + spark_hash(("l", right), ("i", seed * sharding.ROUNDS + k)) % a) % a
            else:
                right = (right + spark_hash(("l", left), ("i", seed * sharding.ROUNDS + k)) % b) % b
        i = left * b + right
        if i < n:
            return i


@pytest.mark.parametrize(("n", "seed"), [(1, 1), (2, 5), (97, 20), (1000, 20), (1025, 3)])
def test_feistel_written_out(spark, n, seed):
    got = {r.id: r.p for r in spark.range(n).select("id", sharding.feistel(F.col("id"), n, seed).alias("p")).collect()}
    assert got == {i: feistel(i, n, seed) for i in range(n)}


def test_shards_written_out(spark):
    """Shard and slot of a row are those of its number's place."""
    docs = spark.createDataFrame([(k, f"text {k % 7}" if k % 5 else None) for k in range(300)], "doc_id long, text string")
    slim = docs.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 16).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    number = {r.doc_id: r.row_number for r in sharding.numbered(slim, ["doc_id", "size", "text_crc32"]).collect()}
    assert sorted(number.values()) == list(range(300))
    for r in sharding.shard_documents(docs, 7, 11).collect():
        place = feistel(number[r.doc_id], 300, 11)
        assert (r.shard, r.slot) == (place % 7, place // 7)


def sample(term, weight, k):
    h, g, b = (spark_hash(("l", term), ("i", k * 3 + j)) & (1 << 64) - 1 for j in range(3))
    low, high = (lambda x: ((x & 0xFFFFFFFF) + 0.5) * 2.0**-32), (lambda x: ((x >> 32) + 0.5) * 2.0**-32)
    r = -math.log(low(h) * high(h))
    beta = (b >> 11) * 2.0**-53
    return math.log(-math.log(low(g) * high(g))) - r * (math.floor(math.log(weight) / r + beta) - beta + 1)


def fingerprint(text):
    counts = Counter(text.lower().split())
    out = []
    for k in range(weighted_sampling.SAMPLES):
        values = [sample(spark_hash(("s", w)), n, k) for w, n in counts.items()]
        out.append(min(values, default=None))
    return out


def test_fingerprints_written_out(spark):
    """Which samples two texts share, and so their likeness, is what the samples written out share."""
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(80)]
    texts = {k: " ".join(rng.choice(words) for _ in range(rng.randrange(40))) for k in range(30)} | {30: "", 31: "One one ONE two", 32: "one two\ttwo\n"}
    rows = weighted_sampling.fingerprints(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    own = {k: fingerprint(t) for k, t in texts.items()}
    alike = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / weighted_sampling.SAMPLES
    order = sorted(texts, reverse=True)
    prints = {r.doc_id: [r.fingerprint[k : k + 4] for k in range(0, 128, 4)] for r in rows}
    for r in rows:
        following = order[(order.index(r.doc_id) + 1) % len(order)]
        text, given = texts[r.doc_id], texts[following]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + given[:cut]
        assert r.near_next == alike(own[r.doc_id], own[following])
        assert r.near_edited == alike(own[r.doc_id], fingerprint(edited))
        for other, theirs in prints.items():  # equal samples have equal digits, others differ but for a chance of 2**-16
            same = [x == y for x, y in zip(own[r.doc_id], own[other], strict=True)]
            digits = [x == y for x, y in zip(prints[r.doc_id], theirs, strict=True)]
            assert all(d for s, d in zip(same, digits, strict=True) if s) and sum(d and not s for s, d in zip(same, digits, strict=True)) <= 1
