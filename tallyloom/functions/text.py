"""Loose casts, labels and page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import SPACES, clean_optional

# Tokens, labels and patterns that results depend on.
TRUE_TOKENS = ("true", "1", "yes", "y", "on")
FALSE_TOKENS = ("false", "0", "no", "n", "off")
MALE_LABELS = ("male", "man", "men", "mens", "boy", "boys")
FEMALE_LABELS = ("female", "woman", "women", "womens", "girl", "girls")
UNISEX_LABELS = ("unisex", "all-gender", "all genders", "gender neutral", "gender-neutral")
SHOP_MARKERS = ("/cart", "/checkout", "add-to-cart", "products")
SOCIAL_PATTERN = r"(?i)instagram\.com/([A-Za-z0-9_.-]+)"
HIDDEN_TAGS = ("script", "style", "noscript", "svg", "template")
ENTITIES = {"&amp;": "&", "&#39;": "'", "&nbsp;": " ", "&ndash;": "-", "&rsquo;": "'", "&quot;": '"'}
EXCLUDED_PAGE_WORDS = r"(?i)privacy|cookie|gdpr|ccpa|accessibility|legal|imprint|terms[\s\-_]*(?:of[\s\-_]*(?:service|use)|and[\s\-_]*conditions)|do[\s\-_]*not[\s\-_]*sell"
POLICY_LEAD = r"(?i)^\W*(?:refund|return|shipping|delivery|exchange|order|store polic)"
# End of fixed values.

TERSE_CHARS, NAV_CHARS, HEAD_CHARS = 800, 400, 200


def loose_bool(x: Column) -> Column:
    token = F.lower(F.btrim(x, F.lit(SPACES)))
    return F.when(token.isin(*TRUE_TOKENS), True).when(token.isin(*FALSE_TOKENS), False)


def loose_int(x: Column) -> Column:
    """Whole number in a text; null for anything else."""
    text = F.btrim(x, F.lit(SPACES))
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def price_cents(x: Column) -> Column:
    """Half a cent rounds away from zero; null for what is no number."""
    return F.round(F.btrim(x, F.lit(SPACES)).try_cast("decimal(38,6)") * 100, 0).cast("bigint")


def gender_token(x: Column) -> Column:
    """male, female, unisex or null, of a tag, option value, type or title."""
    compact = F.translate(F.lower(F.btrim(x, F.lit(SPACES))), "'’", "")
    words = F.split(compact, "[^a-z0-9]+")
    has = lambda *names: F.arrays_overlap(words, F.array(*map(F.lit, names)))
    both = lambda a, b: F.array_contains(words, a) & F.array_contains(words, b)
    return (
        F.when(compact.isin(*MALE_LABELS), "male").when(compact.isin(*FEMALE_LABELS), "female").when(compact.isin(*UNISEX_LABELS), "unisex")
        .when(has("unisex") | both("all", "gender") | both("gender", "neutral"), "unisex")
        .when(has(*FEMALE_LABELS), "female").when(has(*MALE_LABELS), "male")
    )


def social_handle(html: Column) -> Column:
    return F.nullif(F.btrim(F.regexp_extract(html, SOCIAL_PATTERN, 1), F.lit("/@ ")), F.lit(""))


def store_profile(html: Column, website: Column, require_signal: bool = False) -> Column:
    """title (else the website), address (text of the address element), handle, store_type of a home page.

    Online: one of the shop markers; or, unless a signal is required, no address. Offline stores have no handle.
    """
    low, address = F.lower(html), F.nullif(squash(F.regexp_replace(F.regexp_extract(html, r"(?is)<address[^>]*>(.*?)</address>", 1), "<[^>]+>", " ")), F.lit(""))
    online = F.lit(False)
    for m in SHOP_MARKERS:
        online = online | F.contains(low, F.lit(m))
    if not require_signal:
        online = online | address.isNull()
    title = F.coalesce(F.nullif(title_of(html), F.lit("")), website)
    return F.struct(title.alias("title"), address.alias("address"), F.when(online, social_handle(html)).alias("handle"), F.when(online, "online").otherwise("offline").alias("store_type"))


def squash(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, r"\s+", " "), F.lit(" "))


def visible_text(html: Column) -> Column:
    """Text of a page without hidden blocks and tags, a few entities decoded, white space squashed."""
    text = html
    for tag in HIDDEN_TAGS:
        text = F.regexp_replace(text, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    text = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return squash(text)


def title_of(html: Column) -> Column:
    return squash(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), "<[^>]+>", " "))


def signal_count(text: Column, signals: str) -> Column:
    """How many different matches of a pattern (case aside) a text holds."""
    return F.size(F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(signals), F.lit(0)), F.lower)))


def looks_like_policy(text: Column, signals: str, nav: str) -> Column:
    """Two different signals; or one in a short text without navigation words."""
    n = signal_count(text, signals)
    return (n >= 2) | ((n == 1) & (F.length(text) <= TERSE_CHARS) & ~text.rlike(nav))


def legal_page(text: Column) -> Column:
    """Reads as privacy, terms or the like: not if it leads with policy words."""
    head = F.regexp_replace(F.ltrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), r"^[A-Z][A-Z &]+:\s*", "")
    return ~head.rlike(POLICY_LEAD) & F.left(head, F.lit(HEAD_CHARS)).rlike(EXCLUDED_PAGE_WORDS)


def candidate_score(text: Column, signals: str, nav: str, shipping: str | None = None) -> Column:
    """Signals a thousand characters, a tenth of it behind a navigation head; for shipping, raised by its own words."""
    n = signal_count(text, signals)
    score = n / F.greatest(F.lit(1.0), F.length(text) / F.lit(1000.0))
    score = F.when(F.left(text, F.lit(NAV_CHARS)).rlike(nav), score * 0.1).otherwise(score)
    if shipping:
        score = score * (1.0 + F.least(F.regexp_count(text, F.lit(shipping)), F.lit(12)) / F.lit(2.0))
    return F.when(n < 2, F.lit(0.0)).otherwise(score)


def policy_weak(text: Column, signals: str, nav: str, least: float = 2.0) -> Column:
    """A stored policy that is blank, legal, no policy, or long and thin behind a navigation head."""
    density = signal_count(text, signals) / (F.length(text) / F.lit(1000.0))
    return (
        F.when(clean_optional(text).isNull() | legal_page(text) | ~looks_like_policy(text, signals, nav), True)
        .when((F.length(text) <= TERSE_CHARS) | (density >= least), False)
        .otherwise(F.left(text, F.lit(NAV_CHARS)).rlike(nav))
    )


def category_text(text: Column, category: str, shipping: str, returns: str) -> Column:
    """Of a text in several blocks, those of a category: shipping with two hits and as many as returns, returns with
    more hits than shipping; the whole text where none is left."""
    blocks = F.filter(F.transform(F.split(text, r"\n\n"), lambda b: F.btrim(b, F.lit(SPACES))), lambda b: b != "")
    ship, back = (lambda b, p=p: F.regexp_count(b, F.lit(p)) for p in (shipping, returns))
    keep = (lambda b: (ship(b) >= 2) & (ship(b) >= back(b))) if category == "shipping" else (lambda b: back(b) > ship(b))
    kept = F.array_join(F.filter(blocks, keep), "\n\n")
    return F.when(F.size(blocks) <= 1, text).otherwise(F.coalesce(F.nullif(kept, F.lit("")), text))


def hits(text: Column, pattern: str) -> Column:
    """start and end (from 0) of each match of a pattern, in order."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    gaps = F.transform(F.split(text, pattern), F.length)
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("size")))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    def step(acc, p):
        start = F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0)) + p["gap"]
        return F.concat(acc, F.array(F.struct(start.cast("int").alias("start"), (start + p["size"]).cast("int").alias("end"))))
    return F.aggregate(pairs, empty, step)


def returns_section(text: Column, start: str, content: str, stop: str, buffer_stop: str, gap: int = 900, tail: int = 120, cap: int = 4000, least: int = 80) -> Column:
    """The returns discussion inside a legal text: from its heading through hits that follow closely and are not parted
    by a boundary, plus a short tail up to the next boundary; null where nothing of substance is found."""
    at = F.regexp_instr(text, F.lit(start))
    section = F.when(at > 0, F.substring(text, at, F.lit(1 << 30)))
    def step(acc, h):
        between = F.substring(section, acc["end"] + 1, F.greatest(h["start"] - acc["end"], F.lit(0)))
        go = ~acc["done"] & ((acc["end"] == 0) | ((F.length(between) <= gap) & ~between.rlike(stop)))
        return F.struct(F.when(go, h["end"]).otherwise(acc["end"]).alias("end"), (~go).alias("done"))
    run = F.aggregate(hits(section, content), F.struct(F.lit(0).alias("end"), F.lit(False).alias("done")), step)["end"]
    rest = F.substring(section, run + 1, F.lit(1 << 30))
    edge = F.regexp_instr(rest, F.lit(buffer_stop))
    more = F.when(edge > 0, F.least(edge - 1, F.lit(tail))).otherwise(F.lit(tail))
    cut = F.btrim(F.substring(F.substring(section, F.lit(1), run + more), 1, cap), F.lit(SPACES))
    return F.when((run > 0) & (F.length(cut) >= least), cut)


def shipping_window(text: Column, anchor: str, chrome: str, shipping: str, returns: str, size: int = 3200, cap: int = 4000) -> Column:
    """The first window behind an anchor, cut at page chrome, with three shipping hits and as many as returns hits."""
    def window(h):
        part = F.substring(text, h["start"] + 1, F.lit(size))
        edge = F.regexp_instr(part, F.lit(chrome))
        return F.btrim(F.when(edge > 0, F.substring(part, F.lit(1), edge - 1)).otherwise(part), F.lit(SPACES))
    fits = lambda w: (F.regexp_count(w, F.lit(shipping)) >= 3) & (F.regexp_count(w, F.lit(shipping)) >= F.regexp_count(w, F.lit(returns)))
    return F.substring(F.try_element_at(F.filter(F.transform(hits(text, anchor), window), fits), F.lit(1)), 1, cap)


def short_message(text: Column, limit: int = 180) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit - 3)), F.lit("..."))).otherwise(text)


def duration_text(seconds: Column) -> Column:
    """`1h02m`, `4m10s` or `45s`."""
    s = F.greatest(seconds, F.lit(0)).cast("bigint")
    h, m, r = F.floor(s / 3600).cast("int"), F.floor((s % 3600) / 60).cast("int"), (s % 60).cast("int")
    return F.when(h > 0, F.format_string("%dh%02dm", h, m)).when(m > 0, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def zip_code(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\b(\d{5})\b", 1), F.lit(""))


def house_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"^\s*(\d+)\b", 1), F.lit(""))


def geocode_score(zip_wanted: Column, number: Column, found: Column) -> Column:
    """2 for the zip, 1 for the house number as a number of its own, no ordinal."""
    text = F.coalesce(found, F.lit(""))
    by_zip = F.when(zip_wanted.isNotNull() & F.rlike(text, F.concat(F.lit(r"\b"), zip_wanted, F.lit(r"\b"))), 2).otherwise(0)
    by_number = F.when(number.isNotNull() & F.rlike(text, F.concat(F.lit(r"(?<!\d)"), number, F.lit(r"(?!\d|(?:st|nd|rd|th)\b)"))), 1).otherwise(0)
    return by_zip + by_number
