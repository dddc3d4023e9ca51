from pyspark.sql import functions as F

from tallyloom.functions import text as T
from tallyloom.functions import urls as U


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], f"k int, x {kind}")
    return [r[0] for r in df.orderBy("k").select(column(F.col("x"))).collect()]


def test_domain_identity(spark):
    urls = ["https://www.a.com/x", "http://A.com", "a.com/", "www.a.com", " HTTPS://www.a.com "]
    assert values(spark, U.domain_key, urls) == ["a.com"] * 5
    assert values(spark, U.canonical_website, urls) == ["https://a.com"] * 5


def test_normalize_url(spark):
    assert values(spark, U.normalize_url, ["a.com/x?y", "http://b.com/", "https://a b.com", "", None]) == ["https://a.com", "http://b.com", None, None, None]


def test_prices(spark):
    assert values(spark, T.price_cents, ["89.50", "120.99", "", "free", None, "0.005", "NaN"]) == [8950, 12099, None, None, None, 1, None]


def test_loose_casts(spark):
    assert values(spark, T.loose_bool, ["TRUE", "0", "off", "2", None]) == [True, False, False, None, None]
    assert values(spark, T.loose_int, [" 7 ", "-3", "3.7", "x", None]) == [7, -3, None, None, None]


def test_gender_tokens(spark):
    words = ["Women’s", "mens", "women's-clothing", "for all genders", "gender neutral fit", "unisex men", "shirt", ""]
    assert values(spark, T.gender_token, words) == ["female", "male", "female", None, "unisex", "unisex", None, None]


def test_join_url(spark):
    join = lambda x: U.join_url(F.lit("https://s.com/a/b"), x)
    assert values(spark, join, ["http://x.org/1", "//y.org/2", "/p/3", "q"]) == ["http://x.org/1", "https://y.org/2", "https://s.com/p/3", "https://s.com/q"]


def test_policy_text(spark):
    signals, nav = r"\b(?:refund|30 days|final sale)\b", "(?i)my account"
    texts = ["Refund within 30 days.", "All pieces are final sale.", "My account: final sale", "final sale " + "x" * 900, "shipping"]
    assert values(spark, lambda x: T.looks_like_policy(x, signals, nav), texts) == [True, True, False, False, False]
    assert values(spark, T.legal_page, ["Privacy notice", "RETURNS: Privacy policy", "Refund policy and privacy", ""]) == [True, True, False, False]


def test_hits_have_offsets(spark):
    found = values(spark, lambda x: T.hits(x, "ab"), ["xxabyab", "none", "abab"])
    assert [[(h.start, h.end) for h in row] for row in found] == [[(2, 4), (5, 7)], [], [(0, 2), (2, 4)]]


def test_returns_section(spark):
    text = "Terms. Returns policy: you may return goods for a refund in 30 days if unworn and with a receipt and labels on. Limitation of liability applies. Return it."
    cut = values(spark, lambda x: T.returns_section(x, r"(?i)returns? policy", r"(?i)\breturn|\brefund", r"(?i)limitation of liab", r"(?i)limitation of liab|governing law"), [text, "nothing"])
    assert cut[0].startswith("Returns policy") and cut[0].endswith("labels on.") and cut[1] is None


def test_geocode_score(spark):
    score = lambda x: T.geocode_score(F.lit("10001"), F.lit("42"), x)
    assert values(spark, score, ["42 Main St 10001", "5th Ave & 42nd St 10001", "42 Main St 99999", None]) == [3, 2, 1, 0]


def test_durations(spark):
    assert values(spark, T.duration_text, [45, 250, 3723, -5], "int") == ["45s", "4m10s", "1h02m", "0s"]
