"""Commands as chains: resumption, dry runs, and what they leave alone. Digest diffs, SQL functions and layouts."""

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyloom.functions import sql as SQL
from tallyloom.functions import text as T
from tallyloom.operators import commands as M
from tallyloom.operators import reconcile as R
from tallyloom.operators import sets as S
from tallyloom.sources import layout as Y

from test_runs import PAGE, RETURNS, SHIPPING, WORDS, page

KEYS = ["domain", "product_id"]
SAVED = "domain string, product_id string, item_name string, price_cents long, unavailable boolean"


@pytest.fixture
def shop(spark):
    pages = spark.createDataFrame([page("a.com", 1, [1, 2]), page("a.com", 2, []), page("b.com", 1, [1]), page("b.com", 2, [], 503)], PAGE)
    products = spark.createDataFrame([("a.com", "1", "old", 1, False), ("a.com", "9", "gone", 1, False), ("b.com", "1", "old", 1, False), ("b.com", "8", "kept", 1, False), ("b.com", "7", "kept", 1, False), ("c.com", "1", "other", 1, False)], SAVED)
    return pages, products


COLUMNS = ["item_name", "price_cents", "unavailable"]


def test_refresh(spark, shop, tmp_path):
    pages, products = shop
    run = M.Run(spark, str(tmp_path), "r1")
    done = M.refresh_products(run, pages, products, COLUMNS, F.lit(False))
    rows = {(r.domain, r.product_id): (r.item_name, r.price_cents, r.unavailable) for r in done.products.collect()}
    # b.com's walk broke off and matched a third: nothing there is marked; nothing is inserted; c.com was not scraped
    assert rows == {("a.com", "1"): ("t1", 100, False), ("a.com", "9"): ("gone", 1, True), ("b.com", "1"): ("t1", 100, False), ("b.com", "8"): ("kept", 1, False), ("b.com", "7"): ("kept", 1, False), ("c.com", "1"): ("other", 1, False)}
    assert {r.domain: r.reason for r in done.plan.collect()} == {"a.com": "flag", "b.com": "low coverage"}
    held = M.refresh_products(M.Run(spark, str(tmp_path), "r2"), pages, products, COLUMNS, F.lit(False), domain="https://www.A.com", dry_run=True)
    assert held.products.collect() == products.collect() and [r.domain for r in held.plan.collect()] == ["a.com"]
    kept = M.refresh_products(M.Run(spark, str(tmp_path), "r3"), pages, products, COLUMNS, F.col("product_id") == "1", mark_removed=False)
    assert kept.products.where("unavailable").count() == 0 and kept.diff.where("kind = 'matched'").count() == 0


def test_a_killed_run_resumes(spark, shop, tmp_path, monkeypatch):
    pages, products = shop
    plan = R.removal_plan
    monkeypatch.setattr(R, "removal_plan", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    first = M.Run(spark, str(tmp_path), "r")
    with pytest.raises(RuntimeError):
        M.refresh_products(first, pages, products, COLUMNS, F.lit(False))
    assert first.made == ["listed", "ends", "diff"] and not first.done("plan")
    monkeypatch.setattr(R, "removal_plan", plan)
    again = M.Run(spark, str(tmp_path), "r")
    done = M.refresh_products(again, pages, products, COLUMNS, F.lit(False))
    assert again.made == ["plan"] and done.products.where("unavailable").count() == 1


def test_crawl(spark, tmp_path):
    def photo(domain, n, ids, status=200):
        items = ", ".join(f'{{"id": {k}, "title": "t{k}", "images": [{{"src": "u{k}a"}}, {{"src": "u{k}b"}}{", " + chr(123) + chr(34) + "src" + chr(34) + ": " + chr(34) + "c" + chr(34) + chr(125) if k != 3 else ""}], "variants": [{{"price": "{k}.00", "available": {"false" if k == 5 else "true"}}}]}}' for k in ids)
        return (domain, n, status, f'{{"products": [{items}]}}')

    pages = spark.createDataFrame([photo("a.com", 1, [1, 2, 3, 4, 5]), photo("a.com", 2, []), photo("b.com", 1, [], 500), photo("d.com", 1, [1]), photo("d.com", 2, [])], PAGE)
    sites = spark.createDataFrame([(f"https://{d}.com", f"{d}.com") for d in "abcd"], "website string, domain string")
    runs = spark.createDataFrame([("r", "https://d.com", "completed", 1, None), ("old", "https://a.com", "failed", 2, "x")], "run_id string, website string, status string, attempts int, error string")
    products = spark.createDataFrame([("a.com", "1", 1, False, ["s"], ["up"], "g"), ("a.com", "6", 1, False, ["s"], None, None), ("d.com", "9", 1, False, ["s"], None, None)], "domain string, product_id string, price_cents long, unavailable boolean, images array<string>, uploaded array<string>, gender_probs string")
    verdicts = [("a.com", str(k), i, "not_a_product_photo" if k == 2 or (k == 1 and i == 1) else None, 0.4) for k in (1, 2, 3, 5) for i in range(3)]
    verdicts = spark.createDataFrame(verdicts, "domain string, product_id string, i int, code string, prob double")
    done = M.crawl_stores(M.Run(spark, str(tmp_path), "r"), sites, runs, pages, products, verdicts, F.lit(False), most_images=3)
    rows = {(r.domain, r.product_id): (r.price_cents, r.unavailable, list(r.images), r.uploaded, r.gender_probs) for r in done.products.collect()}
    # 1 loses its bad image and keeps its upload; 2 fails; 3 is new; 4 waits for a verdict; 5 is new and sold out; 6 is gone
    assert rows == {("a.com", "1"): (100, False, ["u1a", "c"], ["up"], None), ("a.com", "3"): (300, False, ["u3a", "u3b"], None, None), ("a.com", "6"): (1, True, ["s"], None, None), ("d.com", "9"): (1, False, ["s"], None, None)}
    assert {(r.run_id, r.website): (r.status, r.attempts) for r in done.runs.collect()} == {("r", "https://a.com"): ("completed", 1), ("r", "https://b.com"): ("failed", 1), ("r", "https://c.com"): ("pending", 1), ("r", "https://d.com"): ("completed", 1), ("old", "https://a.com"): ("failed", 2)}
    assert [r.product_id for r in done.dropped.collect()] == ["2"] and done.staged.count() == 5
    fresh = M.crawl_stores(M.Run(spark, str(tmp_path), "r9"), sites, runs, pages, products, verdicts, F.lit(False), fresh=True, cap=1, mark_removed=False)
    assert sorted((r.domain, r.product_id) for r in fresh.staged.collect()) == [("a.com", "1"), ("d.com", "1")] and fresh.products.where("unavailable").count() == 0


def test_recapture_command(spark, tmp_path):
    stores = spark.createDataFrame([(1, "a.com", "https://a.com/", None, None), (2, "a.com", "https://a.com/", "x", None), (3, "b.com", "https://b.com", RETURNS, "https://b.com/p")], "id long, domain string, website string, policy string, policy_url string")
    homes = spark.createDataFrame([(1, "https://a.com/", "<body><a href='/our-returns'>Returns</a></body>"), (3, "https://b.com", "<body>nothing</body>")], "page_id long, url string, html string")
    landed = [("https://a.com/our-returns", f"<body><div>{RETURNS}<div>{'Refund at once. ' * 10}</div></div></body>"), ("https://a.com/pages/shipping", f"<main>{SHIPPING}</main>"), ("https://else.com", "<p>x</p>")]
    landed = spark.createDataFrame([(u, h, h) for u, h in landed], "url string, html string, text string")
    run = M.Run(spark, str(tmp_path), "p")
    done = M.recapture_policies(run, stores, homes, landed, WORDS, {"returns": "(?i)return", "shipping": "(?i)ship"}, "(?i)polic", "(?i)login")
    rows = {r.id: (r.policy, r.policy_url) for r in done.stores.collect()}
    assert rows[1] == rows[2] and rows[1][0].startswith("RETURNS:\n") and "SHIPPING:\n" in rows[1][0] and "Refund at once." in rows[1][0]
    assert rows[1][1] == "https://a.com/our-returns | https://a.com/pages/shipping" and rows[3] == (RETURNS, "https://b.com/p")
    assert run.made == ["links", "candidates", "blocks", "found", "decisions"]
    assert {r.domain: r.action for r in done.decisions.collect()} == {"a.com": "write", "b.com": "leave"}


def test_digest_diff(spark):
    rng = random.Random(1)
    production = [("big", str(k)) for k in range(2000)] + [(f"d{k % 20}", str(k)) for k in range(400)] + [("twice", "1"), ("twice", "1"), ("lost", "1")]
    scraped = [x for x in production if x[0] not in ("lost", "twice")] + [("new", "1"), ("twice", "1"), ("twice", "2"), ("twice", "2")]
    scraped = [x for x in scraped if x != ("big", "77")] + [("big", "x1"), ("d3", "y")]
    rng.shuffle(scraped)
    p, s = (spark.createDataFrame(x, "domain string, product_id string") for x in (production, scraped))
    got = sorted(map(tuple, R.digest_diff(p, s, KEYS).collect()))
    assert got == sorted(map(tuple, R.catalog_diff(p, s, KEYS).collect()))
    changed = R.changed_ranges(p, s, "domain", "product_id", 64)
    assert changed.where("domain = 'big'").count() <= 2 and {r.domain for r in changed.collect()} == {"big", "d3", "twice", "lost", "new"}
    assert R.digest_diff(p.where("domain = 'big'"), p.where("domain = 'big'"), KEYS, unique=True).where("kind = 'matched'").count() == 2000


def test_sql_functions(spark):
    names = SQL.register(spark)
    assert len(names) == len(SQL.FUNCTIONS) >= 20
    texts = [None, "", "  ", "HTTP://www.Shop.com/a?b#c", "shop.com", "$1,234.50", "12.5", "yes", "Women's", "<title>T</title><p>x &amp; y</p> instagram.com/me", "Privacy policy of 12 Elm St 10001", "a" * 300, "77"]
    df = spark.createDataFrame([(t, "https://b.com/x/") for t in texts], "x string, y string")
    for name, (parameters, helper) in SQL.FUNCTIONS.items():
        n = len(parameters.split(", "))
        arguments = ["x", "y", "y"][:n] if "BIGINT" not in parameters else ["length(x)"]
        got = df.selectExpr(f"{name}({', '.join(arguments)}) AS r").collect()
        assert got == df.select(helper(*map(F.expr, arguments)).alias("r")).collect(), name
    SQL.register_one(spark, "short_5", "text STRING", lambda t: T.short_message(t, 5))
    assert spark.sql("SELECT short_5('abcdefghij') AS s").first().s == spark.range(1).select(T.short_message(F.lit("abcdefghij"), 5)).first()[0]
    with pytest.raises(AnalysisException):  # a helper with a lambda function in it
        SQL.register_one(spark, "is_policy", "text STRING", lambda t: T.looks_like_policy(t, WORDS.signals, WORDS.nav))


def test_pages_open_few_files(spark, tmp_path):
    opened = {}
    for n in (2_000, 20_000):
        path = str(tmp_path / str(n))
        rows = spark.range(n).select((F.col("id") * 2).alias("id"), F.lit("x" * 50).alias("x")).repartition(8)
        Y.write(rows, path, "id", rows_a_file=200)
        table = Y.Layout(spark, path, "id")
        got = table.page(1001, 250)
        assert [r.id for r in got.collect()] == list(range(1002, 1502, 2))
        opened[n] = len(got.inputFiles())
        assert [r.id for r in table.page(None, 3).collect()] == [0, 2, 4] and table.page(2 * n, 5).count() == 0 and table.page(2 * n - 4, 5).count() == 1
        window = table.window(500, 900)
        assert window.count() == 201 and len(window.inputFiles()) <= 5
        assert len(table.rows.inputFiles()) >= n // 200
    assert opened[20_000] <= 5 and opened[2_000] <= 5
    # a key that fills several files, and rows without one
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 7).when(F.col("id") < 990, F.col("id")).alias("k"), "id")
    Y.write(rows, str(tmp_path / "hot"), "k", "id", rows_a_file=100)
    hot = Y.Layout(spark, str(tmp_path / "hot"), "k", "id")
    assert [(r.k, r.id) for r in hot.page(6, 5).collect()] == [(7, k) for k in range(5)] and len(hot.page(6, 150).inputFiles()) <= 3
    assert [r.id for r in hot.page(6, 150).collect()] == list(range(150)) and [r.k for r in hot.page(7, 3).collect()] == [900, 901, 902] and hot.window(7, 7).count() == 900


def test_difference_equals_the_anti_join(spark, monkeypatch):
    rng = random.Random(3)
    left = [(rng.randrange(3000), rng.choice("ab")) for _ in range(4000)] + [(None, "a"), (1, None)] * 3
    right = [(rng.randrange(1500), rng.choice("ab")) for _ in range(3000)] + [(None, "a")]
    a, b = (spark.createDataFrame(x, "k int, s string") for x in (left, right))
    wanted = sorted(map(str, a.join(b, ["k", "s"], "left_anti").collect()))
    assert sorted(map(str, S.difference(a, b, ["k", "s"]).collect())) == wanted
    maybe = a.join(F.broadcast(S.bloom(b, ["k", "s"])), S.may_hold(["k", "s"]), "left_semi")
    sure = len({x for x in left} - {x for x in right})
    assert maybe.distinct().count() <= len({x for x in left} & {x for x in right}) + 0.05 * sure + 2  # few false positives
    assert S.difference(a, b.where("false"), ["k", "s"]).count() == len(left) and S.difference(a.where("false"), b, ["k", "s"]).count() == 0
    monkeypatch.setattr(S, "MOST_BITS", 128)  # a filter that is full lets everything pass, and the answer is the same
    assert sorted(map(str, S.difference(a, b, ["k", "s"]).collect())) == wanted
