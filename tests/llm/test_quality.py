"""Results against brute force, exact round trips and held-out accuracy."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import byte_bpe, language, near_dedup, packing, registry, sharding, toxicity, urls, weighted_sampling

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return dict(map(tuple, docs.select("doc_id", "text").collect()))


@pytest.mark.parametrize("n", [1, 2, 3, 40, 97, 1000])
def test_feistel_is_a_permutation(spark, n):
    places = [r[0] for r in spark.range(n).select(sharding.feistel(F.col("id"), n, 20)).collect()]
    assert sorted(places) == list(range(n)) and (n < 40 or places != list(range(n)))


def test_row_numbers_do_not_depend_on_partitions(spark, docs):
    one = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(docs).collect()}
    assert one == {r.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(docs.repartition(7)).collect()}


def test_bpe_equals_the_library(texts):
    import tiktoken

    own = byte_bpe.bpe(byte_bpe.RANKS)
    lib = tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=own.rank, special_tokens={})
    rng = random.Random(3)
    made = ["".join(rng.choice("abeéhint ñ\n'.,19你") for _ in range(rng.randrange(300))) for _ in range(500)] + ["ab" * 500, "a" * 3000, "\x1c \x85 \xa0x", " \n \n a"]
    for text in [*texts.values(), *made]:
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == lib.encode_ordinary(text)
        assert own.decode(got) == text.encode()


def test_packing_ids_equal_the_tokenizer(docs, texts):
    import zlib

    own = packing.encoder(packing.VOCABULARY)
    whole = {d: np.array(own.tokenizer.encode(t, add_special_tokens=False).ids + [packing.END], "<u4") for d, t in texts.items()}
    seen = Counter()
    for r in packing.pack_documents(docs).collect():
        assert r.ids_crc32 == zlib.crc32(whole[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == whole[r.doc_id].size
        seen[r.doc_id] += r.length
    assert seen == {d: w.size for d, w in whole.items()}


def test_neighbours_are_the_best_bm25_scores():
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 60, rng.integers(1, 12)) for _ in range(40)]
    n, held = len(words), Counter(w for own in words for w in set(own.tolist()))
    mean = np.mean([w.size for w in words])
    index = packing.Index(words, packing.Statistics(n, sum(w.size for w in words), np.bincount([w for own in words for w in set(own.tolist())], minlength=1 << packing.SLOT_BITS)))

    def score(q, d):
        total = 0.0
        for w in set(words[q].tolist()) & set(words[d].tolist()):
            tf = (words[d] == w).sum()
            total += np.log(1 + (n - held[w] + 0.5) / (held[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * words[d].size / mean))
        return total

    unused = np.ones(n, bool)
    unused[0] = False
    got = list(index.neighbours(0, unused))
    scores = [score(0, d) for d in got]
    assert scores == sorted(scores, reverse=True) and set(got) == {d for d in range(1, n) if score(0, d) > 0}


def test_windows_are_filled_greedily_by_the_seeds_scores():
    rng = np.random.default_rng(9)
    words = [rng.choice(400, rng.integers(3, 40), p=np.arange(1, 401)[::-1] ** 2.0 / (np.arange(1, 401) ** 2.0).sum()) for _ in range(60)]
    sizes = rng.integers(20, 1500, 60).tolist()
    held = np.bincount([w for own in words for w in set(own.tolist())], minlength=1 << packing.SLOT_BITS)
    corpus = packing.Statistics(60, sum(w.size for w in words), held)
    got = packing.pack(sizes, packing.Index(words, corpus))

    def score(q, d):
        total = 0.0
        for w in set(words[q].tolist()) & set(words[d].tolist()):
            tf = (words[d] == w).sum()
            total += np.log(1 + (60 - held[w] + 0.5) / (held[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * words[d].size / corpus.mean))
        return total

    # written out: the order in which documents are taken
    order, unused, filled, seed = [], list(range(60)), 0, None
    while unused:
        near = [] if seed is None else sorted((d for d in unused if score(seed, d) > 0), key=lambda d: (-round(score(seed, d), 4), d))
        doc = near[0] if near else unused[0]
        seed = doc if not near else seed
        unused.remove(doc)
        order.append(doc)
        if filled + sizes[doc] >= packing.LENGTH:
            seed = doc
        filled = (filled + sizes[doc]) % packing.LENGTH
        seed = seed if filled else None
    assert list(dict.fromkeys(d for d, *_ in got)) == order


def test_corpus_statistics_and_places(spark, docs, texts):
    rows, corpus = packing.placed(docs.repartition(5))
    runs = {d: t.lower().split() for d, t in texts.items()}
    held = Counter(s for r in runs.values() for s in {int(x) & ((1 << packing.SLOT_BITS) - 1) for x in packing.word_hashes(pa.array(r, pa.string()))})
    wanted = packing.Statistics(len(texts), sum(map(len, runs.values())), np.bincount(list(held.elements()), minlength=1 << packing.SLOT_BITS))
    assert corpus.mean == wanted.mean and np.array_equal(corpus.idf, wanted.idf)
    place = {r.doc_id: r.place for r in rows.collect()}
    assert set(place) == set(texts) and all(place[d] in packing.word_hashes(pa.array(r, pa.string())) for d, r in runs.items() if r)
    assert {r.doc_id: r.place for r in packing.placed(docs)[0].collect()} == place


def shingles(text):
    w = text.lower().split()
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(texts):
    sets, least = {d: shingles(t) for d, t in texts.items()}, {d: d for d in texts}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    order = sorted(texts)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            both = sum((sets[a] & sets[b]).values())
            if texts[a] == texts[b] or both and both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = root(a), root(b)
                least[max(x, y)] = min(x, y)
    return {d: root(d) for d in texts}


def test_near_duplicates_equal_brute_force(spark, docs, texts):
    rng = random.Random(7)
    base = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(900)) for _ in range(300))
    words, more = base.split(), dict(texts)
    for k in range(60):  # a group around one text whose members are less like each other
        own = list(words)
        for at in rng.sample(range(300), 5):
            own[at] = f"new{k}x{at}"
        more[10_000 + k] = " ".join(own)
    more[20_000] = base
    df = spark.createDataFrame(list(more.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()} == brute_classes(more)


@pytest.mark.parametrize("block", [2048, 16])
def test_partners_behind_nearer_sketches_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)  # with 16, buckets are cut into parts
    rng = random.Random(11)
    words, texts = [f"word{k}" for k in range(6000)], {}
    for k in range(40):  # two texts of similarity 0.804 among 78 others of about 0.78, whose sketches are often nearer
        spots = rng.sample(range(5, 5990, 5), 140)
        for own in (spots[:75], spots[65:]):
            text = list(words)
            for at in own:
                text[at] = f"new{k}x{at}"
            texts[len(texts)] = " ".join(text)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    wanted = brute_classes(texts)
    assert len(set(wanted.values())) == 40
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()} == wanted


def test_texts_on_a_common_template_lose_no_link(spark):
    rng = random.Random(1)
    template, texts, pairs = [f"common{k}" for k in range(300)], {}, 400
    for k in range(pairs):  # each two share the template and some words of their own; all others only the template
        own = [f"pair{k}x{j}" for j in range(8)]
        for half in range(2):
            texts[2 * k + half] = " ".join(template + own + [f"one{k}x{half}x{j}" for j in range(34)])
    wanted = brute_classes({k: texts[k] for k in rng.sample(range(0, 60), 40)})
    assert len(wanted) > len(set(wanted.values())) > 20
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {k: k - k % 2 for k in texts}


def test_signatures_collide_as_often_as_sets_are_alike():
    row, element, weight = np.array([0, 0, 1, 1, 1]), np.array([1, 2, 1, 2, 3], np.uint64), np.array([0.5, 2.3, 1.7, 1.1, 0.4])
    s = near_dedup.signatures(2, row, element, weight, 8000)
    assert abs((s[0] == s[1]).mean() - 1.6 / 4.4) < 0.02


def test_fingerprints_estimate_generalised_jaccard(docs, texts):
    rows = weighted_sampling.fingerprints(docs).collect()
    order = sorted(texts, reverse=True)
    after = {d: texts[order[(k + 1) % len(order)]] for k, d in enumerate(order)}
    off = []
    for r in rows:
        a = texts[r.doc_id]
        cut = len(a) // 3
        x, y = Counter(a.lower().split()), Counter((a[: len(a) - cut] + after[r.doc_id][:cut]).lower().split())
        off.append(r.near_edited - sum((x & y).values()) / max(1, sum((x | y).values())))
    assert abs(np.mean(off)) < 0.02 and np.sqrt(np.mean(np.square(off))) < 0.11


def brute_scores(shares, links):
    """trust and distrust by plain iteration; shares: host -> (allowed, blocked); links: (src, dst) -> n."""
    edges = Counter(links)
    for host in shares:
        labels = host.split(".")
        for k in range(len(labels) - 2):
            child, parent = ".".join(labels[k:]), ".".join(labels[k + 1 :])
            edges[child, parent] = links.get((child, parent), 0) + 1
            edges[parent, child] = links.get((parent, child), 0) + 1
    hosts = set(shares) | {h for e in edges for h in e}
    total = Counter()
    for (src, _), n in edges.items():
        total[src] += n
    share = {h: shares.get(h, (0.0, 0.0)) for h in hosts}
    base = [{h: share[h][0] for h in hosts}, {h: float(h in shares) for h in hosts}, {h: share[h][1] for h in hosts}]
    now = [dict(b) for b in base]
    for _ in range(urls.ROUNDS):
        new = [dict(b) for b in base]
        for (src, dst), n in edges.items():
            w = urls.DAMPING * n / total[src]
            for k in (0, 1):
                new[k][dst] += w * now[k][src]
            new[2][src] += w * (1 - sum(share[src])) * now[2][dst]
        now = new
    return {h: (now[0][h] / now[1][h] if now[1][h] else 0.0, now[2][h]) for h in hosts}


def test_propagation_decides_what_no_rule_judges(spark):
    rules = {"bad.test/": "block", "good.test/": "allow", "part.test/x/": "block"}
    page = lambda url, *to: (url, " ".join(f"<a href='http://{t}/'>t</a>" for t in to))
    rows = [page("http://bad.test/1", "mid.test"), page("http://good.test/1", "part.test", "fine.test")]
    for n in (2, 10, 1000):  # hosts that link only to a blocked one, however many do
        rows += [page(f"http://only{n}k{k}.test/", f"n{n}.bad.test") for k in range(n)] + [page(f"http://n{n}.bad.test/")]
    rows += [page("http://part.test/x/1"), page("http://part.test/x/2"), page("http://part.test/y")]  # two of three pages blocked
    rows += [page(f"http://s{k}.good.test/", "part.test") for k in range(12)]  # ... but trusted hosts link to it
    rows += [page("http://fine.test/", "good.test", "bad.test"), page("http://lone.test/")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r.host: r.verdict for r in urls.judge_pages(df, rules).where("rule IS NULL").collect()}
    assert {v for h, v in got.items() if h.startswith("only")} == {"block"}
    assert got["part.test"] == got["fine.test"] == got["lone.test"] == "allow"
    shares = {"bad.test": (0.0, 1.0), "good.test": (1.0, 0.0), "part.test": (0.0, 2 / 3), "fine.test": (0.0, 0.0), "lone.test": (0.0, 0.0)}
    shares |= {f"n{n}.bad.test": (0.0, 1.0) for n in (2, 10, 1000)} | {f"s{k}.good.test": (1.0, 0.0) for k in range(12)} | {f"only{n}k{k}.test": (0.0, 0.0) for n in (2, 10, 1000) for k in range(n)}
    links = Counter((u.split("/")[2], t.split("'")[0]) for u, html in rows for t in html.split("http://")[1:] for t in [t.split("/")[0]])
    wanted = brute_scores(shares, links)
    hosts = spark.createDataFrame([(h, *x) for h, x in shares.items()], "host string, allowed double, blocked double")
    edges = urls.host_edges(df.select("*", F.regexp_extract("url", "//([^/]*)", 1).alias("host")), hosts)
    scores = {r.host: (r.trust, r.distrust) for r in urls.host_scores(hosts, edges).collect()}
    assert all(abs(x - y) < 1e-6 for h, s in scores.items() for x, y in zip(s, wanted[h], strict=True))
    assert wanted["part.test"][1] > urls.THRESHOLD  # its own share alone would block it


def test_language_on_held_out_documents(docs):
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.95


def test_unknown_languages_and_gibberish_are_rejected(spark, docs, texts):
    strange = ["你好世界这是一个测试文本", "Привет мир это проверка текста", "xqzvk jjwqx zzkqv wqxjz kqvxz", "asdf qwer zxcv poiu lkjh mnbv", "12 34"]
    more = docs.unionByName(spark.createDataFrame([(50_000 + k, t) for k, t in enumerate(strange)], "doc_id long, text string"), allowMissingColumns=True)
    assert {r.doc_id for r in language.known_language(more).collect()} == set(texts)


def test_language_equals_kernel_ridge_regression_written_out(spark):
    rng = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "efghijkl", "cc": "ijklmnop"}
    rows = [(k, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(2, 6))) for _ in range(12)), lang) for k in range(90) for lang in [rng.choice(sorted(letters))]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df, landmarks=5)
    used = {r.doc_id for r in language.fit_sample(df).collect()}
    place = {r.doc_id: r.k for r in df.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    fitted = sorted((r for r in rows if r[0] in used), key=lambda r: r[0])
    marks = sorted(m for lang in letters for m in sorted((r for r in fitted if r[2] == lang), key=lambda r: place[r[0]])[:5])
    mark_sets = [set(language.grams(m[1]).tolist()) for m in marks]
    features = set().union(*mark_sets)

    def kernel(text):
        own = set(language.grams(text).tolist()) & features
        return np.array([len(own & m) / np.sqrt(max(1, len(own)) * len(m)) for m in mark_sets])

    size, turn = np.linalg.eigh(np.array([kernel(m[1]) for m in marks]))
    phi = lambda text: kernel(text) @ turn[:, size > 1e-6 * size.max()] / np.sqrt(size[size > 1e-6 * size.max()])
    x, y = np.array([phi(r[1]) for r in fitted]), np.array([[1.0 if r[2] == lang else -1.0 for lang in sorted(letters)] for r in fitted])
    centred = x - x.mean(0)
    w = np.linalg.solve(centred.T @ centred + language.RIDGE * len(x) * np.eye(x.shape[1]), centred.T @ (y - y.mean(0)))
    for r in rows:
        values = (phi(r[1]) - x.mean(0)) @ w + y.mean(0)
        (name,), (score,), _ = language.score([r[1]], model, model.table())
        assert name == sorted(letters)[values.argmax()] and abs(score - np.clip((1 + values.max()) / 2, 0, 1)) < 1e-3


def test_fits_read_one_row_of_a_repeated_id(spark):
    rows = [(0, f"text {k} of many", "en") for k in range(300)] + [(k, "ein anderer text", "de") for k in range(1, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.fit_sample(df, fit_rows=5).collect()
    assert len({r.doc_id for r in got}) == len(got) <= 10
    assert all(r.text == "text 0 of many" for r in got if r.doc_id == 0)
    again = language.fit(df.repartition(7), fit_rows=5)
    assert np.array_equal(again.weights, language.fit(df, fit_rows=5).weights)
    labels = spark.createDataFrame([(0, 1, 1)] + [(k, 1, 0) for k in range(1, 40)], "doc_id long, quality int, toxic int")
    chains = [toxicity.fit(x, labels) for x in (df, df.repartition(7))]
    assert all(np.array_equal(a.weights, b.weights) and a.bias == b.bias for a, b in zip(*chains, strict=True))


def test_toxicity_on_documents_it_was_not_fitted_on(spark):
    labels, big = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("labels", "documents"))
    away = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    rows = toxicity.classify(big, labels.where(~away)).join(labels.where(away), "doc_id").collect()
    hit = [r for r in rows if r.toxic and r.is_toxic]
    assert len(hit) > 0.85 * sum(r.toxic for r in rows) and len(hit) > 0.95 * sum(r.is_toxic for r in rows)


def test_later_links_of_the_chain_use_earlier_ones():
    rng = np.random.default_rng(1)
    n = 600
    first = rng.integers(0, 2, n)
    row, feature = np.arange(n), first + 10  # one feature: the first category
    goals = np.column_stack([first, first])
    chain = toxicity.fit_chain(["a", "b"], row, feature, goals, np.arange(n) % 5)
    assert chain[1].earlier.size == 1 and chain[1].earlier[0] > 0


def test_chain_equals_one_written_out(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_RATIO", -1.0)
    monkeypatch.setattr(toxicity, "LEAST_TEXTS", 1)
    monkeypatch.setattr(toxicity, "RIDGE", 1e-2)
    rng = np.random.default_rng(8)
    n, width = 200, 6
    x = (rng.random((n, width)) < 0.4).astype(float)
    first = (x[:, 0] + x[:, 1] + rng.normal(0, 0.7, n) > 1).astype(int)
    goals, fold = np.column_stack([first, ((first + x[:, 2] + rng.normal(0, 0.5, n)) > 1.2).astype(int)]), np.arange(n) % 5

    def fitted(a, y):  # Newton steps; the bias is not ridged
        a = np.column_stack([a, np.ones(len(a))])
        w, keep = np.zeros(a.shape[1]), np.full(a.shape[1], toxicity.RIDGE)
        keep[-1] = 0
        for _ in range(50):
            p = 1 / (1 + np.exp(-a @ w))
            w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a / len(a) + np.diag(keep), a.T @ (p - y) / len(a) + keep * w)
        return lambda b: 1 / (1 + np.exp(-np.column_stack([b, np.ones(len(b))]) @ w))

    earlier, wanted = np.zeros((n, 0)), np.zeros((n, 0))
    for k in range(2):
        a, out = np.column_stack([x, earlier]), np.zeros(n)
        for f in range(5):
            out[fold == f] = fitted(a[fold != f], goals[fold != f, k])(a[fold == f])
        wanted = np.column_stack([wanted, fitted(a, goals[:, k])(np.column_stack([x, wanted]))])
        earlier = np.column_stack([earlier, out])
    row, feature = np.nonzero(x)
    got = np.zeros((n, 0))
    for link in toxicity.fit_chain(["a", "b"], row, feature.astype(np.int64), goals, fold):
        got = np.column_stack([got, toxicity._apply(link, n, row, feature.astype(np.int64), got)])
    assert np.abs(got - wanted).max() < 5e-3


def test_pipeline_stages_keep_columns_and_take_effect(spark, docs, texts):
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        kept = out.cache()
    classes = brute_classes({r.doc_id: r.text for r in corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.STAGES[0][1](spark, docs, SF), SF).collect()})
    assert {r.doc_id for r in kept.collect()} == {d for d, c in classes.items() if d == c}
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("pages", "embeddings", "conversations", "documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    wanted = con.sql(f"select {', '.join(columns)} from ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, wanted))
