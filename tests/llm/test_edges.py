"""Every operator on nulls, empty and long texts, repeated rows, clashing extra columns and empty tables."""

import hashlib
import json
import os
import random
import tempfile
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import byte_bpe, language, near_dedup, norm_search, packing, shared, sharding, tool_calls, toxicity, urls, weighted_sampling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, bucket long, node long, score double, label string, _n long"
BIG = (1 << 60) + 1
TEXTS = [
    (1, "the cat sat on the mat and went to the other side of the road"), (2, None), (3, ""), (4, "the cat sat on the mat and went to the other side of the road"), (None, "null id"), (None, None),
    (1, "the cat sat on the mat and went to the other side of the road"), (BIG, "x"), (6, "  \n "), (7, "one two three four five six seven " * 4000), (8, "été ñ 你好 \U0001f600 don't <|endoftext|> a\x85b"), (9, "12345 !!"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if k % 2 else "fr", "s", None, "k", 1, 2, 0.5, "l", 3) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(rows):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in rows)


WANTED = sorted((i is None, i or 0) for i, _ in TEXTS)


def test_sharding(odd, none):
    rows = sharding.shard_documents(odd, shards=5).collect()
    assert ids(rows) == WANTED and sharding.shard_documents(none).count() == 0
    sizes = sorted(sum(r.shard == s for r in rows) for s in range(5))
    assert sizes[-1] - sizes[0] <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows))) for s in range(5))
    by = {r.doc_id: r for r in rows}
    assert (by[2].size, by[2].text_crc32) == (16, 0) and by[8].text_crc32 == zlib.crc32(TEXTS[10][1].encode())


def test_language(odd, none):
    rows = language.identify(odd).collect()
    assert ids(rows) == WANTED
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (2, 3, 6, 9)} == dict.fromkeys((2, 3, 6, 9), "und")
    assert all(r.lang_pred in ("en", "fr", "und") and 0 <= r.score <= 1 for r in rows)
    known = odd.where(f"doc_id IN (7, {BIG})")
    more = odd
    for k in range(20, 28):  # texts of 7 and BIG under ids that are fitted on: what they hold is known then
        more = more.unionByName(known.withColumn("doc_id", F.col("doc_id") + k))
    kept = language.known_language(more)
    assert kept.columns == odd.columns and {1, 4, 7, 8, BIG} <= {r.doc_id for r in kept.collect()}
    assert not {2, 3, 6, 9} & {r.doc_id for r in kept.collect()}
    assert language.identify(none).count() == 0 and language.known_language(none).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (4, None, 1), (7, 1, 0), (99, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.classify(odd, labels).collect()
    assert ids(rows) == WANTED and all(r.p_toxic == 0 and not r.is_toxic for r in rows if r.doc_id in (2, 3, 6))
    assert toxicity.classify(none, labels).count() == 0
    assert not any(r.is_toxic for r in toxicity.classify(odd, labels.where("false")).collect())
    assert toxicity.without_toxic(odd, labels.where("false")).count() == len(TEXTS)


def test_near_dedup(odd, none):
    rows = near_dedup.near_duplicates(odd).collect()
    assert ids(rows) == WANTED and near_dedup.near_duplicates(none).count() == 0
    assert {r.doc_id: r.class_id for r in rows if r.doc_id in (1, 4, 2, 3, 6)} == {1: 1, 4: 1, 2: 2, 3: 3, 6: 6}
    assert all(r.class_id is None and r.keep for r in rows if r.doc_id is None)
    kept = near_dedup.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 6, 7, 8, 9, BIG]


def test_packing(odd, none):
    rows = packing.pack_documents(odd).collect()
    assert packing.pack_documents(none).count() == 0
    assert {r.doc_id for r in rows} == {i for i, _ in TEXTS}
    assert all(r.doc_tokens == 1 for r in rows if r.doc_id in (2, 3, 6))
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at & (at - 1) == 0 and at <= packing.LENGTH


def test_byte_bpe(odd, none):
    rows = byte_bpe.encode_documents(odd).collect()
    assert ids(rows) == WANTED and byte_bpe.encode_documents(none).count() == 0
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].n_tokens == by[3].n_tokens == 0
    for i, t in TEXTS:
        if i is not None:
            assert by[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_weighted_sampling(odd, none):
    rows = weighted_sampling.fingerprints(odd).collect()
    assert ids(rows) == WANTED and weighted_sampling.fingerprints(none).count() == 0
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[1].fingerprint == by[4].fingerprint and by[2].fingerprint == by[3].fingerprint == by[6].fingerprint
    assert by[3].near_next == 1.0  # its next document is 2, both without words
    order = sorted((i for i, _ in TEXTS if i is not None), reverse=True)
    text = {i: t or "" for i, t in TEXTS if i is not None}
    order = list(dict.fromkeys(order))
    for k, i in enumerate(order):
        t, after = text[i], text[order[(k + 1) % len(order)]]
        cut = len(t) // 3
        assert by[i].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest() and by[i].n_chars == len(t)


def test_norm_search(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, []), (None, [9.0, 9.0]), (7, [0.0, 0.0]), (2, [-1.0, 0.0]), (8, [1.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, label int, bucket int")
    got = norm_search.top_products(df, k=3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got if r.query_id == 0] == [(0, 1, 1, 1024**2), (0, 2, 8, 1024**2), (0, 3, 100, 512 * 1024)]
    assert norm_search.top_products(df.where("false")).count() == 0
    assert {r.query_id for r in got} == {0, 100}


def test_norm_search_is_exact_on_great_components(spark):
    rng = random.Random(2)
    size = [1.0, 3e6, 1e12, 1e14, 1e300, 1.7e308]
    vectors = {k: [rng.choice((-1, 1)) * rng.random() * rng.choice(size) for _ in range(6)] for k in range(0, 1200, 20)} | {1: [0.0] * 6, 3: [1e300] + [0.0] * 5}
    whole = {k: [(Fraction(x) * 1024).__floor__() for x in v] for k, v in vectors.items()}
    score = lambda a, b: min(max(sum(x * y for x, y in zip(whole[a], whole[b], strict=True)), -(2**63)), 2**63 - 1)
    wanted = {(q, r, c, score(q, c)) for q in vectors if q % 100 == 0 for r, c in enumerate(sorted((c for c in vectors if c != q), key=lambda c: (-score(q, c), c))[:5], 1)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    assert {tuple(r) for r in norm_search.top_products(df, k=5).select("query_id", "rank", "vec_id", "score").collect()} == wanted


def test_norm_search_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(norm_search, "BLOCK_ROWS", 32)
    monkeypatch.setattr(norm_search, "QUERY_ROWS", 4)
    rng = random.Random(3)
    vectors = {k: [rng.randrange(-900, 900) * rng.choice((1, 1, 5)) / 1024 for _ in range(8)] for k in range(0, 4000, 5)}
    score = lambda a, b: sum(round(x * 1024) * round(y * 1024) for x, y in zip(vectors[a], vectors[b], strict=True))
    wanted = {(q, r, c, score(q, c)) for q in vectors if q % 100 == 0 for r, c in enumerate(sorted((c for c in vectors if c != q), key=lambda c: (-score(q, c), c))[:10], 1)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    assert {tuple(r) for r in norm_search.top_products(df).select("query_id", "rank", "vec_id", "score").collect()} == wanted


def test_fingerprints_of_far_ids(spark):
    far = [-(1 << 63), -5, 0, 7, 8, (1 << 63) - 1]
    rows = {r.doc_id: r for r in weighted_sampling.fingerprints(spark.createDataFrame([(i, f"text number {i} of some") for i in far], "doc_id long, text string")).collect()}
    for k, i in enumerate(far):
        t, after = (f"text number {j} of some" for j in (i, far[k - 1]))
        cut = len(t) // 3
        assert rows[i].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()


def test_urls(spark):
    rows = [(1, "http://A.NET/x", None), (2, "https://b.example.net/en/1?q", "<a href='//c.org/'>"), (3, None, None), (4, "no scheme", ""), (5, "https://x.example.com/de/", ""), (5, "https://x.org/fr", ""), (None, "http://net?x", "")]
    df = spark.createDataFrame([(*r, 1, "h") for r in rows], "page_id long, url string, html string, n int, host string")
    got = {(r.page_id, r.host): (r.path, r.rule, r.verdict) for r in urls.judge_pages(df).collect()}
    assert got == {
        (1, "a.net"): ("/x", "net/", "block"), (2, "b.example.net"): ("/en/1", "example.net/en/", "allow"), (3, ""): ("", None, "allow"), (4, ""): ("", None, "allow"),
        (5, "x.example.com"): ("/de/", "example.com/de/", "block"), (5, "x.org"): ("/fr", None, "allow"), (None, "net"): ("", None, "allow"),
    }
    assert urls.judge_pages(df.where("false")).count() == 0


FIXED = {
    "search": {"query": ("string", True), "limit": ("integer", False), "after": ("string", False)},
    "lookup": {"key": ("integer", True), "after": ("string", False)},
    "send": {"text": ("string", True), "urgent": ("boolean", True), "after": ("string", False)},
}


def brute_levels(needs):
    level = {}
    while True:
        new = {c: max((level[d] + 1 for d in ds), default=0) for c, ds in needs.items() if c not in level and all(d in level for d in ds)}
        if not new:
            return level
        level |= new


def test_levels_of_deep_chains_circles_and_several_dependencies(spark):
    rng = random.Random(6)
    needs = {f"c{k}": {f"c{k - 1}"} if k else set() for k in range(300)}
    needs |= {f"r{k}": {f"r{rng.randrange(k)}" for _ in range(rng.choice((0, 1, 1, 2, 3)))} if k else set() for k in range(120)}
    needs |= {"x0": {"x2"}, "x1": {"x0"}, "x2": {"x1"}, "x3": {"x2"}, "x4": {"x3", "c7"}, "x5": {"x5"}, "x6": {"c299", "r5"}, "x7": {"x6"}, "x8": {"x7", "x6"}}
    calls = spark.createDataFrame([(1, c) for c in needs], "conv_id long, call_id string")
    edges = spark.createDataFrame([(1, c, d) for c, ds in needs.items() for d in ds], "conv_id long, call_id string, needs string")
    got = {r.call_id: r.level for r in tool_calls.levels(calls, edges).collect()}
    assert got == brute_levels(needs) and got["x8"] == 302 and not {"x0", "x3", "x4", "x5"} & set(got)


def test_nested_schemas_and_canonical_json_equal_brute_force(spark):
    schema = {"t": {"a": ({"b": ({"c": ("integer", True)}, True), "d": ("string", False)}, True), "e": ("array", False), "f": ("number", False)}}
    kinds = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict}

    def wrong(value, wanted, path=""):
        out = [f"unexpected {path}{k}" for k in value if k not in wanted]
        for key, (kind, needed) in wanted.items():
            named = "object" if isinstance(kind, dict) else kind
            if key not in value:
                out += [f"missing {path}{key}"] if needed else []
            elif not isinstance(value[key], kinds[named]) or (isinstance(value[key], bool) and named != "boolean"):
                out.append(f"{path}{key} is not {named}")
            elif isinstance(kind, dict):
                out += wrong(value[key], kind, f"{path}{key}.")
        return sorted(out)

    values = [
        {"a": {"b": {"c": 1}}}, {"a": {"b": {"c": "x"}, "d": 2}, "f": 1.5}, {"a": {"b": [1]}, "e": [1, {"z": 1, "y": 2}]}, {"a": {}}, {}, {"a": None}, {"a": {"b": {"c": 2, "zz": 'q"\\ \n é 你'}}, "g": True},
        {"f": "no", "a": {"d": "s", "b": {}}}, [1], "text", 7, {"e": {}, "a": {"b": {"c": -3}}, "f": 3},
    ]
    calls = spark.createDataFrame([(1, f"k{k}", k, "t", json.dumps(v, indent=1, ensure_ascii=k % 2 == 0)) for k, v in enumerate(values)], "conv_id long, call_id string, turn long, name string, arguments string")
    results = spark.createDataFrame([(1, f"k{k}", 100 + k, 'whole "text"\n') for k in range(len(values))], "conv_id long, call_id string, turn long, content string")
    for r in tool_calls.link(calls, results, schema).collect():
        k = int(r.call_id[1:])
        bad = wrong(values[k], schema["t"]) if isinstance(values[k], dict) else ["not an object"]
        assert r.errors == "; ".join(bad) and r.status == ("invalid arguments" if bad else "linked")
        whole = {"arguments": values[k], "call_id": r.call_id, "content": 'whole "text"\n', "level": 0, "name": "t", "result_turn": 100 + k, "turn": k}
        assert r.json == json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_tool_calls(spark):
    arg = '{"query": "a", "after": "$%s"}'
    calls = [(1, "a", 1, "search", '{ "query" : "x" }'), (1, "b", 2, "search", arg % "a"), (1, "c", 0, "search", arg % "b"), (1, "a", 5, "send", "{}"), (1, "d", 6, "search", arg % "e"), (1, "e", 7, "search", arg % "d"), (1, "f", 8, "search", arg % "zz"), (1, "g", 9, "lookup", '{"key": "no"}'), (1, "h", 10, "send", "{"), (None, "q", 1, "x", None), (2, "n", 1, None, None)]
    results = [(1, "a", 3, "ok"), (1, "a", 4, "late"), (1, "o", 2, "orphan"), (1, None, 2, "nameless")]
    c = spark.createDataFrame([(*r, "t") for r in calls], "conv_id long, call_id string, turn long, name string, arguments string, text string")
    r = spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string")
    rows = tool_calls.link(c, r, FIXED).collect()
    got = sorted(((x.call_id or "", x.status, x.level) for x in rows), key=str)
    assert got == sorted([("a", "linked", 0), ("a", "duplicate call", None), ("b", "no result", 1), ("c", "no result", 2), ("d", "circle", None), ("e", "circle", None), ("f", "missing dependency", 0), ("g", "invalid arguments", 0), ("h", "invalid arguments", 0), ("o", "no call", None), ("", "no identifier", None), ("q", "no identifier", None), ("n", "invalid arguments", 0)], key=str)
    (a,) = [x for x in rows if x.call_id == "a" and x.status == "linked"]
    assert a.json == '{"arguments":{"query":"x"},"call_id":"a","content":"ok","level":0,"name":"search","result_turn":3,"turn":1}'
    assert tool_calls.link(c.where("false"), r.where("false")).count() == 0


def test_thousands_of_languages(spark):
    rows = [(k, f"the text of language {k % 1500} is this", f"l{k % 1500}") for k in range(3000)] + [(5000 + k, "bonjour tout le monde et merci", "fr") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit_sample(docs).select("lang").distinct().count() == language.MOST_LANGUAGES
    found = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    assert len(found) == 3040 and found[5000] == "fr"


def test_equal_vectors_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(norm_search, "BLOCK_ROWS", 500)
    sizes = []
    met = norm_search._met
    monkeypatch.setattr(norm_search, "_met", lambda asked, placed, pairs, k: (sizes.append(placed.groupBy("block").count().toPandas()["count"].max()), met(asked, placed, pairs, k))[1])
    df = spark.range(5000).selectExpr("CASE WHEN id < 3 THEN id * 100 ELSE 7 END AS vec_id", "array(1.0D, 2.0D) AS embedding")
    rows = norm_search.top_products(df).collect()
    assert sizes and max(sizes) < 900  # before: 4,997 equal rows in one block
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rows)[:10] == [(0, k, 7) for k in range(1, 11)]


def test_a_doc_id_of_many_texts_does_not_square(spark, monkeypatch):
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join([*base[:k % 60], f"x{k}", *base[k % 60:]])) for k in range(200)] + [(2, " ".join(base))] + [(3, "equal text of one id " * 5)] * 300
    counted = []
    write = near_dedup.cut
    monkeypatch.setattr(near_dedup, "cut", lambda df, name: (out := write(df, name), counted.append(out.count()) if name == "rows" else None)[0])
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 501 and {r.class_id for r in found if r.doc_id < 3} == {1} and {r.class_id for r in found if r.doc_id == 3} == {3}
    assert counted[0] <= 25 * 202


def test_near_dedup_shuffles_few_texts_and_leaves_few_tables(spark, monkeypatch):
    place = tempfile.mkdtemp(prefix="scratch-")
    monkeypatch.setattr(shared, "scratch_dir", lambda spark: place)
    docs = spark.range(3000).selectExpr("CAST(id AS INT) AS doc_id", "concat_ws(' ', transform(sequence(0, 40), k -> substr(md5(concat(id - if(id % 10 = 7, 1, 0), ' ', k)), 1, 6))) AS text", "id AS words", "2 * id AS bits")
    kept = near_dedup.without_near_duplicates(docs)
    assert {x.split("-")[0] for x in os.listdir(place)} == {"found", "gone", "twice"}  # before: all that was cut, signed to classes
    gone = kept._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight, LeftSemi" in gone and "BuildRight, LeftAnti" in gone  # before: a join of all rows with their texts
    rows = kept.collect()
    assert kept.schema == docs.schema and sorted((r.doc_id, r.words, r.bits) for r in rows) == [(k, k, 2 * k) for k in range(3000) if k % 10 != 7]


def test_a_failed_near_dedup_leaves_no_tables(spark, monkeypatch):
    place = tempfile.mkdtemp(prefix="scratch-")
    monkeypatch.setattr(shared, "scratch_dir", lambda spark: place)
    monkeypatch.setattr(near_dedup, "components", lambda links: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        near_dedup.near_duplicates(spark.createDataFrame([(1, "a text"), (2, "a text")], "doc_id long, text string"))
    assert os.listdir(place) == []


def test_rows_without_an_id_are_dealt_out(spark):
    docs = spark.range(8000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'one place for all of these rows' AS text")
    rows, _ = packing.placed(docs)
    parts = packing.together(rows).select(F.spark_partition_id().alias("p")).groupBy("p").count().toPandas()["count"]
    assert len(parts) == 4 and parts.max() < 3000
    assert packing.pack_documents(docs).agg(F.sum("length")).first()[0] == 8000 * packing.pack_documents(docs.limit(1)).agg(F.sum("length")).first()[0]


def test_opening_turns_are_results_of_no_call(spark):
    turns = spark.createDataFrame([("c", 0, "user", "hello"), ("c", 1, "assistant", "hi"), ("c", 2, "user", "thanks"), ("d", 0, "system", "set up")], "conv_id string, turn int, role string, text string")
    rows = {r.call_id: r.status for r in tool_calls.link_conversations(turns).collect()}
    assert set(rows) == {"c--1", "c-1", "d-0"} and rows["c--1"] == "no call"
