import random

from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators import chunks as K
from tallyloom.operators import identity as I
from tallyloom.operators import policies as P
from tallyloom.operators import reconcile as R
from tallyloom.operators import runs as X
from tallyloom.operators import scoring as S
from tallyloom.streaming import jobs as J


def page(domain, n, products, status=200):
    items = ", ".join(f'{{"id": {k}, "title": "t{k}", "variants": [{{"price": "{k}.00"}}]}}' for k in products)
    return (domain, n, status, f'{{"products": [{items}]}}')


PAGE = "domain string, page int, http_status int, body string"


def test_ingest_goes_on_after_a_restart(spark, tmp_path):
    landed, state, progress = (str(tmp_path / x) for x in ("landed", "state", "progress"))

    def arrive(*pages):
        spark.createDataFrame(list(pages), PAGE).coalesce(1).write.mode("append").parquet(landed)
        return J.ingest(spark, J.arrivals(spark, landed, spark.createDataFrame([], PAGE).schema), state, progress, ["item_name", "price_cents"])

    assert arrive(page("a.com", 1, [1])).count() == 1
    rows = arrive(page("a.com", 2, [2, 1]))  # a new query, as after a restart
    assert sorted((r.product_id, r.price_cents) for r in rows.collect()) == [("1", 100), ("2", 200)]
    again = J.ingest(spark, J.arrivals(spark, landed, spark.createDataFrame([], PAGE).schema), state, progress, ["item_name", "price_cents"])
    assert again.count() == 2  # nothing new arrived


def test_two_phases_clear_the_staging_and_resume(spark, tmp_path):
    landed, staging, saved, progress = (str(tmp_path / x) for x in ("landed", "staging", "saved", "progress"))

    def go(*pages):
        if pages:
            spark.createDataFrame(list(pages), PAGE).coalesce(1).write.mode("append").parquet(landed)
        stream = J.arrivals(spark, landed, spark.createDataFrame([], PAGE).schema)
        return sorted(r.product_id for r in J.two_phase(spark, stream, staging, saved, progress, "r1", lambda rows: rows.where("product_id <> '3'")).collect())

    assert go(page("a.com", 1, [1, 3])) == ["1"] and not (tmp_path / "staging" / "run=r1").exists()
    assert go() == ["1"]


def test_watchdog(spark):
    rows = [("a", 0, "view"), ("a", 50, "done"), ("b", 0, "view"), ("b", 90, "view"), ("b", 170, "view"), ("c", 5, "view")]
    beats = spark.createDataFrame(rows, "store string, s long, kind string").select("store", F.timestamp_seconds("s").alias("ts"), "kind")
    got = {r.store: (r.beats, r.verdict) for r in J.idle_sessions(beats, "100 seconds", terminal=("done",), hard_seconds=120).collect()}
    assert got == {"a": (2, "finished"), "b": (3, "over limit"), "c": (1, "stalled")}


def test_inserted_stores_get_ids(spark):
    cols = "domain string, address string, id long, website string, store_name string, policy string"
    cur = spark.createDataFrame([("a", None, 4, "w", "A", "p"), ("a", None, 7, "w", "A2", None)], cols)
    inc = spark.createDataFrame([("a", None, "w", "New", None), ("b", "x", "w", "B", "q"), ("c", None, "w", "C", None)], "domain string, address string, website string, store_name string, policy string")
    rows = {(r.domain, r.id): (r.store_name, r.policy) for r in R.upsert_store(cur, inc).collect()}
    assert rows[("a", 4)] == ("New", "p") and rows[("a", 7)] == ("A2", None)
    assert sorted(i for d, i in rows if d in "bc") == [8, 9]


def test_geocode_pick(spark):
    rows = [("1 A St", 0, "x"), ("1 A St", 1, "1 A St 10001"), ("2 B St, 10002", 0, "2 B"), ("2 B St, 10002", 1, "B 10002"), ("2 B St, 10002", 2, "2 B 10002"), ("3 C St, 10003", 0, "C"), ("3 C St, 10003", 1, "3 C"), ("4 D", 0, None)]
    df = spark.createDataFrame(rows, "address string, provider int, found string")
    assert {r.address: r.provider for r in I.geocode_pick(df).collect()} == {"1 A St": 0, "2 B St, 10002": 1, "3 C St, 10003": 1}


def test_store_profile(spark):
    rows = [("<title>T</title><a href='/cart'><address>1 <b>A</b></address>instagram.com/me/",), ("<address>x</address> instagram.com/me",), ("plain",)]
    df = spark.createDataFrame(rows, "html string")
    got = [tuple(r.p) for r in df.select(T.store_profile(F.col("html"), F.lit("web")).alias("p")).collect()]
    assert got == [("T", "1 A", "me", "online"), ("web", "x", None, "offline"), ("web", None, None, "online")]
    assert [r.p.store_type for r in df.select(T.store_profile(F.col("html"), F.lit("web"), True).alias("p")).collect()] == ["online", "offline", "offline"]


def test_budget_chunks(spark):
    rows = [(1, 1, ["a", "b", " "]), (1, 2, ["a", None, "c"]), (1, 3, ["d"]), (1, 4, []), (1, 5, None), (2, 1, list("abcdef")), (2, 2, ["a"])]
    df = spark.createDataFrame(rows, "store long, ord long, images array<string>")
    got = {(r.store, r.ord): r.chunk for r in K.budget_chunks(df, "store", "ord", 3, 3).collect()}
    assert got == {(1, 1): 0, (1, 2): 0, (1, 3): 1, (1, 4): 1, (1, 5): 1, (2, 1): 0, (2, 2): 1}
    assert {r.chunk for r in K.budget_chunks(df.where("store = 2"), "store", "ord", 3, 3, 2).collect()} == {0}
    assert K.budget_chunks(df.where("false"), "store", "ord", 3, 3).count() == 0


def test_one_store_is_split_among_tasks(spark):
    """One store of all rows, a null store and small ones, in blocks that are composed on three levels."""
    rng = random.Random(2)
    rows = [("big", k, [f"u{rng.randrange(60)}" for _ in range(rng.choice((0, 1, 2, 3, 9)))]) for k in range(3000)]
    rows += [(None, k, ["x"] * k) for k in range(20)] + [(f"s{k % 7}", k, [f"u{k}"]) for k in range(40)]
    df = spark.createDataFrame(rows, "store string, ord long, images array<string>")
    got = {(r.store, r.ord): r.chunk for r in K.budget_chunks(df.repartition(8), "store", "ord", 5, 7, block=5, fan=8).collect()}
    wanted, now, seen = {}, None, None
    for store, order, images in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        if seen is None or store != now:
            now, chunk, n, seen = store, 0, 0, set()
        elif n >= 5 or len(seen | set(images)) > 7:
            chunk, n, seen = chunk + 1, 0, set()
        n, seen = n + 1, seen | set(images)
        wanted[store, order] = chunk
    assert got == wanted
    pos = K._positions(df, "store", "ord", 100, None).where("store = 'big'")
    assert sorted(r.pos for r in pos.collect()) == list(range(3000))


def test_an_outlier_does_not_unbalance_the_ranges(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 7, 1e12).otherwise(F.col("id") / 20_000).alias("x"))
    ranked = S.ranked_counts(df, "x")
    assert ranked.count() == 20_000 and ranked.where("upto - before <> 1 OR n <> 20000").count() == 0
    number, cuts = F.col("x"), [k / S.RANGES for k in range(1, S.RANGES)]
    bounds = df.agg(F.percentile_approx(number, cuts, 16 * S.RANGES)).first()[0]
    import bisect
    from collections import Counter

    sizes = Counter(bisect.bisect_left(bounds, r.x) for r in df.collect())
    assert max(sizes.values()) <= 2 * 20_000 / S.RANGES
    inf, nan = float("inf"), float("nan")
    odd = spark.createDataFrame([(x,) for x in (1.0, nan, None, inf, 2.0, inf)], "x double")
    r = S.distribution(odd, "x").first()
    assert (r.n, r.least, r.p10, r.median, r.p75, r.mean, r.most) == (4, 1.0, 1.3, inf, inf, inf, inf)
    both = S.distribution(spark.createDataFrame([(-inf,), (inf,)], "x double"), "x").first()
    assert both.least == -inf and both.most == inf and str(both.median) == "nan" and str(both.mean) == "nan"
    assert S.distribution(odd.where("false"), "x").first().n == 0


def test_repeated_incoming_stores_are_one(spark):
    cols = "domain string, address string, id long, website string, store_name string"
    cur = spark.createDataFrame([("a", None, 1, "w", "A")], cols)
    inc = spark.createDataFrame([("a", None, "w", "A1", 1), ("a", None, "w", "A2", 2), ("n", None, "w", "N2", 4), ("n", None, "w", "N1", 3), ("n", "x", "w", "NX", 0)], "domain string, address string, website string, store_name string, k int")
    got = sorted((r.domain, r.address or "", r.id, r.store_name) for r in R.upsert_store(cur, inc, ordinal="k").collect())
    assert [(d, a, n) for d, a, _, n in got] == [("a", "", "A2"), ("n", "", "N2"), ("n", "x", "NX")] and sorted(i for *_, i, _ in got) == [1, 2, 3]
    assert R.upsert_store(cur, inc.drop("k")).count() == 3


def test_doomed_products_without_a_uuid_go(spark):
    products = spark.createDataFrame([(1, None), (2, None), (3, "v"), (None, "w")], "pid long, uuid string")
    embeddings = spark.createDataFrame([("v",), ("w",), (None,)], "uuid string")
    for limit in (None, 3):
        done = X.remove_products(products, embeddings, F.expr("pid = 1 OR pid IS NULL OR pid = 3"), "uuid", "pid", limit=limit)
        assert [r.pid for r in done.products.collect()] == [2] and [r.uuid for r in done.embeddings.collect()] == [None]


def test_exact_percentiles(spark):
    values = [0.5, 0.1, 0.1, 0.9, 0.3, 0.7, 0.1]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    r = S.distribution(df, "x").first()
    e = df.selectExpr("percentile(x, array(0.1, 0.25, 0.5, 0.75, 0.9)) p").first().p
    assert [r.p10, r.p25, r.median, r.p75, r.p90] == [round(x, 6) for x in e] and (r.n, r.least, r.most) == (7, 0.1, 0.9)


WORDS = P.Vocabulary(r"(?i)refund|return|ship|days", r"(?i)menu", r"(?i)ship", r"(?i)return", section=r"(?i)returns policy", stop=r"(?i)governing law", edge=r"(?i)governing law|privacy", anchor=r"(?i)shipping rates", chrome=r"(?i)footer")
RETURNS = "You may return goods and get a refund within 30 days of buying them here. " * 3
SHIPPING = "We ship at once and shipping takes 3 days for any shipping address we ship to. " * 3


def test_capture(spark):
    pages = [
        ("both", "returns", 0, "both/r", RETURNS), ("both", "shipping", 0, "both/s", SHIPPING), ("both", "shipping", 1, "both/rates", "menu ship return days refund. Standard shipping $5.00. " + "x" * 400),
        ("same", "returns", 0, "same/p", RETURNS + SHIPPING), ("same", "shipping", 0, "same/p", RETURNS + SHIPPING), ("menu", "returns", 0, "menu/r", "Menu return " * 40), ("legal", "returns", 0, "legal/r", "Privacy: " + RETURNS),
    ]
    tab = "To return goods for a refund ship them in 30 days, return. " * 5
    pages = [(*p, p[-1]) for p in pages] + [("tab", "shipping", 0, "tab/p", tab, tab + "Shipping rates: we ship, ship, ship and ship all. " * 30 + " footer return return")]
    sites = spark.createDataFrame([(s,) for s in ("both", "same", "menu", "home", "legal", "tab", "none")], "site string")
    homes = spark.createDataFrame([("home", "home/", RETURNS + " and we ship too"), ("both", "both/", RETURNS), ("none", "none/", "short")], "site string, url string, text string")
    terms = spark.createDataFrame([("legal", 1, "legal/2", "Terms. Returns Policy: " + RETURNS + "Governing law: none."), ("legal", 0, "legal/1", "nothing"), ("both", 0, "both/t", "Returns policy. " + RETURNS)], "site string, ord long, url string, text string")
    df = spark.createDataFrame(pages, "site string, category string, ord long, url string, text string, page string")
    got = {r.site: (r.text, r.urls) for r in P.capture(sites, df, homes, terms, WORDS, least=100).collect()}
    assert got["none"] == got["menu"] == (None, None)
    text, urls = got["both"]
    assert urls == "both/r | both/s" and text.startswith("RETURNS:\n" + RETURNS.strip()[:50]) and "\n\nSHIPPING:\n" in text and text.endswith("Shipping rates: Standard shipping $5.00.")
    assert got["same"] == ("SHIPPING & RETURNS:\n" + RETURNS + SHIPPING, "same/p")
    assert got["home"][1] == "home/" and got["home"][0].startswith("SHIPPING & RETURNS:\n")
    assert got["legal"][1] == "legal/2" and got["legal"][0].startswith("RETURNS:\nReturns Policy: You may return") and "Governing" not in got["legal"][0]
    assert got["tab"][1] == "tab/p" and got["tab"][0].startswith("SHIPPING:\nShipping rates: we ship") and "footer" not in got["tab"][0]


def test_recapture(spark):
    stored = spark.createDataFrame([("good", RETURNS), ("kept", RETURNS), ("weak", "Privacy notice"), ("fixed", None), ("gone", None)], "k string, policy string")
    found = spark.createDataFrame([("good", "new"), ("fixed", "new")], "k string, text string")
    run = lambda **how: {r.k: (r.action, r.policy) for r in P.recapture(stored, found, "k", WORDS, **how).collect()}
    assert run() == {"good": ("refresh", "new"), "kept": ("leave", RETURNS), "weak": ("leave", "Privacy notice"), "fixed": ("write", "new"), "gone": ("leave", None)}
    assert run(clear_unfixable=True, only_broken=True) == {"weak": ("clear", None), "fixed": ("write", "new"), "gone": ("clear", None)}


def test_content_text(spark):
    strong, other = "We refund and return within 30 days.", "We ship in 2 days for free, returns too."
    rows = [(1, f"<body><nav>ship return</nav><div><p>{strong}</p></div><main>{other}</main><section>blah</section></body>"), (2, "<body><p>only this</p><script>x</script></body>"), (3, ""), (4, f"<main>{strong} Yes.</main><section>{strong}</section>")]
    got = {r.page_id: r.text for r in P.content_text(spark.createDataFrame(rows, "page_id long, html string"), WORDS.signals, WORDS.nav).collect()}
    assert got == {1: f"{strong}\n\n{other}", 2: "only this", 3: None, 4: f"{strong} Yes."}


def test_nested_blocks_keep_their_text(spark):
    rows = [
        (1, "<body><div>one <DIV class='a'>two</DIV> three <section>four</section> five</div> six <main>seven</body>"), (2, "<div>a</div></div><div>b<div>c</div>d</div>"), (3, "<div><section>x</div>y</section>z"),
        (4, "<article><nav><div>gone</div></nav>kept</article>"), (5, None),
    ]
    got = {}
    for r in P.content_blocks(spark.createDataFrame(rows, "page_id long, html string")).where("block").orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got == {1: ["one two three four five", "two", "four", "seven"], 2: ["a", "b c d", "c"], 3: ["x", "x y"], 4: ["kept"]}
    df = spark.createDataFrame([(1, "<div>We refund and return <div>and ship for free</div> within 30 days</div>")], "page_id long, html string")
    assert [r.text for r in P.content_text(df, WORDS.signals, WORDS.nav).collect()] == ["We refund and return and ship for free within 30 days"]


def test_candidates(spark):
    sites = spark.createDataFrame([("https://s",)], "site string")
    links = spark.createDataFrame([("https://s", 0, "https://s/a", "Store rules"), ("https://s", 1, "https://s/b", "Returns"), ("https://s", 2, "https://s/pages/returns", "Returns"), ("https://s", 3, "https://s/c", "About")], "site string, ord long, url string, label string")
    rows = P.candidates(sites, links, {"returns": "(?i)return", "shipping": "(?i)ship"}, "(?i)rules").collect()
    order = {c: [r.url for r in sorted((r for r in rows if r.category == c), key=lambda r: r.ord)] for c in ("returns", "shipping")}
    assert order["returns"][-2:] == ["https://s/b", "https://s/a"] and order["returns"].count("https://s/pages/returns") == 1
    assert order["shipping"][-1] == "https://s/a" and "https://s/b" not in order["shipping"]
    pages = spark.createDataFrame([("https://s/b", "text")], "url string, text string")
    assert [r.url for r in P.landed(P.candidates(sites, links, {"returns": "(?i)return", "shipping": "(?i)ship"}, "x"), pages).collect()] == ["https://s/b"]


def test_prune_cascades_and_reports(spark):
    stores = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, domain string")
    products = spark.createDataFrame([(1, "p"), (2, "q"), (2, "r")], "store_id long, product_id string")
    keep = stores.select("domain").where("domain = 'a'")
    done = X.prune_stores(stores, products, keep, "domain")
    assert [r.id for r in done.stores.collect()] == [1] and done.products.count() == 1 and tuple(done.report.first()) == (2, 2, 2, False)
    held = X.prune_stores(stores, products, keep, "domain", most=1)
    assert held.stores.count() == 3 and held.products.count() == 3 and held.report.first().refused


def test_removed_products_take_their_embeddings_once(spark):
    products = spark.createDataFrame([(1, "u"), (2, "u"), (3, "v"), (4, "w")], "pid long, uuid string")
    embeddings = spark.createDataFrame([("u",), ("v",), ("w",)], "uuid string")
    done = X.remove_products(products, embeddings, F.col("pid").isin(1, 3, 4), "uuid", "pid", limit=2)
    assert sorted(r.pid for r in done.products.collect()) == [2, 4] and sorted(r.uuid for r in done.embeddings.collect()) == ["u", "w"]
    assert sorted(r.pid for r in done.samples.collect()) == [1, 3]
