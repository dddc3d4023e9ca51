from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.operators import policies as P
from tallyloom.operators import scoring as S


def test_rate_merge(spark):
    chosen = spark.createDataFrame([("a", "Ships in 3 days. Priority $9.00"), ("b", "No rates.")], "key string, text string")
    texts = [
        ("a", 1, "Standard shipping: $5.00, Express - $12. Overnight $0.00 free Ground $8.00 Economy orders $50+ Priority $9.00"),
        ("a", 2, "standard shipping: $5.00 and UPS $7.25"), ("b", 1, None),
    ]
    got = {r.key: r.text for r in P.rate_merge(chosen, spark.createDataFrame(texts, "key string, ord int, text string")).collect()}
    assert got == {"a": "Ships in 3 days. Priority $9.00\nShipping rates: Standard shipping $5.00; Express $12; UPS $7.25.", "b": "No rates."}


def test_policy_links(spark):
    html = """<a href="/returns/">Returns</a><a href='/returns#x'>again</a><a class=b href="https://other.org/returns">Returns</a>
      <a href="/privacy">Privacy returns</a><a href="mailto:returns@a.com">Returns</a><a href="//a.com/ship">Shipping <b>info</b></a><a href="/x">About</a>"""
    pages = spark.createDataFrame([(1, "https://a.com/home", html), (2, "https://a.com", None)], "page_id long, url string, html string")
    rows = P.policy_links(pages, "(?i)return|shipping", "(?i)privacy").orderBy("ord").collect()
    assert [(r.url, r.label) for r in rows] == [("https://a.com/returns", "Returns"), ("https://a.com/ship", "Shipping info")]


def test_best_page_is_among_the_first_accepted(spark):
    rows = [("s", 1, True, 1.0), ("s", 2, False, 9.0), ("s", 3, True, 3.0), ("s", 4, True, 3.0), ("s", 5, True, 8.0)]
    df = spark.createDataFrame(rows, "site string, ord int, accepted boolean, score double")
    assert [r.ord for r in P.best_page(df, ["site"]).collect()] == [3]


def test_shipping_window(spark):
    text = "Free shipping! Shop now. Shipping rates: ground shipping, flat rate, customs and carrier notes. Instagram. flat rate flat rate"
    df = spark.createDataFrame([(text,), ("nothing",)], "x string")
    part = T.shipping_window(F.col("x"), r"(?i)free shipping|shipping rates?", r"(?i)instagram", r"(?i)ground shipping|flat rate|customs|carrier", r"(?i)\breturn")
    assert [r[0] for r in df.select(part).collect()] == ["Free shipping! Shop now. Shipping rates: ground shipping, flat rate, customs and carrier notes.", None]


def test_budget_chunks_fill_in_order(spark):
    rows = spark.createDataFrame([(1, k, [f"{k}-{j}" for j in range(5)]) for k in range(12)], "store_id long, pid long, images array<string>")
    chunks = lambda most: [r.chunk for r in S.budget_chunks(rows, "store_id", "pid", 40, most).orderBy("pid").collect()]
    assert chunks(20) == [0] * 4 + [1] * 4 + [2] * 4
    assert chunks(60) == [0] * 12
