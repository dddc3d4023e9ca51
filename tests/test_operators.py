from pyspark.sql import functions as F

from tallyloom.operators import catalog as C
from tallyloom.operators import identity as I
from tallyloom.operators import reconcile as R
from tallyloom.operators import rules as Q
from tallyloom.operators import scoring as S


def test_dedupe_keeps_most_addresses_then_first(spark):
    rows = [(1, "http://a.com", "A", ["x"]), (2, "https://www.a.com", "A2", ["x", "y"]), (3, "b.com", "B", None), (4, "b.com/z", "B2", [])]
    df = spark.createDataFrame(rows, "ord long, store_url string, store_name string, addresses array<string>")
    assert [(r.domain, r.first_ord, r.store_name) for r in I.dedupe_domain(df).orderBy("first_ord").collect()] == [("a.com", 1, "A2"), ("b.com", 3, "B")]


def test_branch_assignment(spark):
    b = spark.createDataFrame([("d", 0, "X"), ("d", 1, "Y"), ("d", 2, "Z"), ("e", 0, None)], "domain string, pos int, address string")
    e = spark.createDataFrame([("d", 1, None), ("d", 2, "Y"), ("d", 3, "Y"), ("d", 4, "Q"), ("d", 5, "R"), ("e", 9, None)], "domain string, id long, address string")
    got = {(r.domain, r.pos, r.id): r.action for r in I.branch_assign(b, e).collect()}
    assert got == {("d", 1, 2): "keep", ("e", 0, 9): "keep", ("d", 0, 1): "reuse", ("d", 2, 3): "reuse", ("d", None, 4): "stale", ("d", None, 5): "stale"}


def test_upsert_is_idempotent_and_policied(spark):
    cols = "store_id long, product_id string, price_cents long, gender_label string, gender_probs string"
    cur = spark.createDataFrame([(1, "a", 5, "male", "p"), (1, "b", 6, None, None)], cols)
    inc = spark.createDataFrame([(1, "a", 7, None, None, 0), (1, "a", 8, None, None, 1), (2, "c", 9, "female", None, 2)], cols + ", ord long")
    once = R.upsert_products(cur, inc)
    rows = sorted(map(tuple, once.collect()))
    assert rows == [(1, "a", 8, "male", "p"), (1, "b", 6, None, None), (2, "c", 9, "female", None)]
    assert sorted(map(tuple, R.upsert_products(once, inc).collect())) == rows


def test_removal_plan_reasons(spark):
    state = spark.createDataFrame([("same", True), ("gone", True), ("thin", False), ("flag", True)], "d string, complete boolean")
    kinds = {"same": ["matched"] * 3, "gone": ["missing"] * 3, "thin": ["matched"] + ["missing"] * 3, "flag": ["matched"] * 2 + ["missing"] + ["new"]}
    diff = spark.createDataFrame([(d, f"{d}{k}", kind) for d, own in kinds.items() for k, kind in enumerate(own)], "d string, product_id string, kind string")
    plan = {r.d: r.reason for r in R.removal_plan(diff, state, "d").collect()}
    assert plan == {"same": "nothing missing", "gone": "empty scrape", "thin": "low coverage", "flag": "flag"}


def test_completeness_table(spark):
    rows = [("empty", 1, 200, 5, 5), ("empty", 2, 200, 0, 0), ("again", 1, 200, 5, 5), ("again", 2, 200, 5, 0), ("key", 1, 200, None, 0), ("late404", 1, 200, 5, 5), ("late404", 2, 404, None, 0), ("late429", 2, 429, None, 0), ("down", 1, 500, None, 0), ("budget", 1, 200, 5, 5)]
    df = spark.createDataFrame(rows, "domain string, page int, http_status int, n_products int, n_new int")
    batch = {r.domain: (r.reason, r.complete) for r in R.completeness(df).collect()}
    assert batch == {"empty": ("empty", True), "again": ("repeated page", True), "key": ("missing key", False), "late404": ("error", False), "late429": ("error", False), "down": ("failed", False), "budget": ("budget", False)}
    stream = {r.domain: r.complete for r in R.completeness(df, streaming=True).collect()}
    assert stream["late404"] and not stream["late429"] and not stream["again"]


def test_attempts_grow_only_from_pending(spark):
    runs = spark.createDataFrame([("r", "a", "pending", 2, "old"), ("r", "b", "completed", 3, None)], "run_id string, website string, status string, attempts int, error string")
    ups = spark.createDataFrame([("r", "a", "failed", None), ("r", "b", "failed", "x" * 3000), ("r", "c", "scraped", None)], "run_id string, website string, status string, error string")
    got = {r.website: (r.status, r.attempts, len(r.error or "")) for r in R.mark_status(runs, ups).collect()}
    assert got == {"a": ("failed", 3, 3), "b": ("failed", 3, 2000), "c": ("scraped", 1, 0)}


def test_prune_guards(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "domain string, id int")
    keep = spark.createDataFrame([("a",)], "domain string")
    assert {r.id for r in R.prune(rows, keep, "domain").where("pruned").collect()} == {2, 3}
    assert R.prune(rows, keep, "domain", most=1).where("pruned").count() == 0
    assert R.prune(rows, keep.where("false"), "domain").where("pruned").count() == 0


def test_rules(spark):
    rows = [("Girlfriend jeans", None), ("Babydoll dress", None), ("Card holder", "bags"), ("Gift card", None), ("Cardigan", None), ("Polish", "Nail Polish"), ("Boob tape dress", None)]
    df = spark.createDataFrame(rows, "n string, t string")
    none = F.lit(None).cast("string")
    words = r"gifts?|cards?|glass"
    got = df.select(Q.excluded_category(F.col("n"), none, none, F.col("t"), words), Q.clear_nonfashion(F.col("n"), none, none, F.col("t"), words, "dress|bags?|jeans")).collect()
    assert [r[0] for r in got] == [True, False, True, True, False, True, False]
    assert [r[1] for r in got] == [False, False, False, True, False, True, True]


def test_extraction_of_one_page(spark):
    body = """{"products": [{"id": 7, "title": "Tee", "handle": "tee", "vendor": "V", "price": null, "tags": ["x", "Women's"],
      "images": [{"src": "u1"}, {"src": ""}], "options": [{"name": "Size", "values": ["M", "S"]}, {"name": "COLOR", "values": ["red"]}],
      "variants": [{"price": "130", "sku": "", "option1": "M"}, {"price": 120.99, "sku": "k", "available": false, "option2": "38"}]}, {"id": 0}, {"title": "no id"}]}"""
    page = spark.createDataFrame([("s.com", 1, 200, body), ("s.com", 2, 200, "{}"), ("s.com", 3, 200, "broken"), ("s.com", 4, 500, None)], "domain string, page int, http_status int, body string")
    (r,) = C.extract_catalog(page).collect()
    assert (r.product_id, r.images, r.sizes, r.colors, r.price_cents, r.sku, r.unavailable, r.gender_label, r.product_url) == ("7", ["u1"], ["38", "M", "S"], ["red"], 12099, "k", True, "female", "https://s.com/products/tee")


def test_lead_image_rule(spark):
    rows = [("pass2", 0, "image_too_blurry", 0.1), ("pass2", 1, None, 0.9), ("drop", 0, "resolution_too_low", 0.2), ("drop", 1, "not_a_product_photo", 0.4), ("wait", 0, "timeout", 0.0), ("wait", 1, "image_too_blurry", 0.3)]
    df = spark.createDataFrame(rows, "p string, i int, code string, prob double")
    got = {r.p: (r.keep, r.reason, r.best_prob) for r in S.lead_image_rule(df, ["p"]).collect()}
    assert got == {"pass2": (True, None, None), "drop": (False, "not_a_product_photo", 0.4), "wait": (True, "timeout", None)}
