"""Policy pages: links, candidates, the best page, missing rates, stored text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions.text import SPACES, squash
from .identity import first_by

# Page paths in order of preference.
RETURNS_PATHS = ("/policies/refund-policy", "/pages/returns", "/pages/return-policy", "/pages/returns-exchanges", "/pages/refund-policy", "/pages/returns-policy")
SHIPPING_PATHS = ("/policies/shipping-policy", "/pages/shipping", "/pages/shipping-policy", "/pages/delivery", "/pages/shipping-info")
COMBINED_PATHS = (
    "/pages/shipping-returns", "/pages/shipping-and-returns", "/pages/returns-shipping", "/pages/shipping-returns-policy", "/pages/online-store-policy", "/pages/store-policy",
    "/pages/store-policies", "/pages/policies", "/pages/our-policies", "/pages/customer-care", "/pages/customer-service", "/pages/faq", "/pages/help",
)
RATE_TIERS = r"standard|expedited|express|ground|economy|priority|overnight|next[\s-]?day|two[\s-]?day|2[\s-]?day|first[\s-]?class|flat[\s-]?rate|usps|ups|fedex|dhl"
RATE_ROW = rf"(?is)((?:{RATE_TIERS})[^$]{{0,90}}?)\$\s?(\d+(?:\.\d{{2}})?)\b(?=(.{{0,4}}))"
BEFORE_RATE = 24
CONTENT_TAGS, CHROME_TAGS = "article|main|section|div", "script|style|noscript|nav|header|footer|form"
TERMS_PATHS = ("/policies/terms-of-service", "/pages/terms-of-service", "/pages/terms-and-conditions", "/pages/terms")
CATEGORIES = ("returns", "shipping")
# End of fixed values.
ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)[^>]*>(.*?)</a>"""


def policy_links(pages: DataFrame, wanted: str, excluded: str) -> DataFrame:
    """page_id, ord, url, label: links of a page whose address or label is wanted and not excluded, on the same host,
    without fragment and last slash, each url once where it comes first."""
    hrefs, labels = (F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(k)) for k in (1, 2))
    rows = pages.select("page_id", "url", F.posexplode(F.arrays_zip(hrefs.alias("href"), labels.alias("label"))).alias("ord", "a"))
    rows = rows.select("page_id", "ord", F.col("url").alias("base"), F.btrim("a.href", F.lit(SPACES)).alias("href"), squash(F.regexp_replace("a.label", "<[^>]+>", " ")).alias("label"))
    both = F.concat_ws(" ", "href", "label")
    rows = rows.where((F.col("href") != "") & both.rlike(wanted) & ~both.rlike(excluded)).withColumn("url", U.join_url(F.col("base"), F.col("href")))
    rows = rows.where(F.col("url").rlike("(?i)^https?:") & (U.host(F.col("url")) == U.host(F.col("base"))))
    rows = rows.withColumn("url", F.rtrim(F.substring_index("url", "#", 1), F.lit("/")))
    return rows.groupBy("page_id", "url").agg(F.min(F.struct("ord", "label")).alias("f")).select("page_id", "f.ord", "url", "f.label")


def candidates(sites: DataFrame, links: DataFrame, wanted: dict[str, str], generic: str) -> DataFrame:
    """site, category, ord, url of sites (site) and their home page's links (site, ord, url, label): a category's own
    paths, combined paths, links that a category's pattern (wanted) finds in address or label, then links that only the
    generic one finds; each url once in a category, where it comes first. The path lists are short constants."""
    found = []
    said = F.concat_ws(" ", "url", "label")
    for category, own in (("returns", RETURNS_PATHS), ("shipping", SHIPPING_PATHS)):
        paths = F.posexplode(F.array(*map(F.lit, own + COMBINED_PATHS))).alias("ord", "path")
        found.append(sites.select("site", paths).select("site", F.lit(category).alias("category"), F.col("ord").cast("long").alias("ord"), F.concat("site", "path").alias("url")))
        rank = F.when(said.rlike(wanted[category]), 1_000).when(said.rlike(generic), 1_000_000)
        found.append(links.select("site", F.lit(category).alias("category"), (F.col("ord") + rank).cast("long").alias("ord"), "url").where("ord IS NOT NULL"))
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    return rows.groupBy("site", "category", "url").agg(F.min("ord").alias("ord"))


def landed(candidates: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates (site, category, ord, url) with the text of their landed page (url, text); without one they go."""
    return candidates.join(pages.select("url", "text"), "url").select("site", "category", "ord", "url", "text")


def best_page(rows: DataFrame, keys: list[str], first: int = 3) -> DataFrame:
    """Of the first accepted candidates (keys, ord, accepted, score) of each key the one of highest score, the earlier
    on a tie."""
    early = rows.where("accepted").withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy("ord"))).where(F.col("_k") <= first)
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "ord")
    return early.withColumn("_b", F.row_number().over(best)).where("_b = 1").drop("_k", "_b")


def rate_rows(texts: DataFrame) -> DataFrame:
    """key, ord, pos, label, amount: rate lines of texts (key, ord, text), without free ones and thresholds."""
    parts = [F.regexp_extract_all("text", F.lit(RATE_ROW), F.lit(k)).alias(n) for k, n in enumerate(("label", "amount", "after"), 1)]
    gaps = F.split("text", RATE_ROW).alias("before")  # what is between the rows, one more than there are
    rows = texts.select("key", "ord", F.posexplode(F.arrays_zip(gaps, *parts)).alias("pos", "r")).select("key", "ord", "pos", "r.*").where("label IS NOT NULL")
    rows = rows.withColumn("before", F.right("before", F.lit(BEFORE_RATE)))
    rows = rows.withColumn("label", F.btrim(F.regexp_replace("label", r"\s+", " "), F.lit(" *–-,:")))
    free = F.lower(F.col("before")).rlike("free|complimentary|over") | F.lower(F.col("label")).rlike("free|over") | F.ltrim("after").startswith("+")
    return rows.where(~free & (F.col("amount").cast("double") > 0)).select("key", "ord", "pos", "label", F.concat(F.lit("$"), "amount").alias("amount"))


def rate_merge(chosen: DataFrame, texts: DataFrame) -> DataFrame:
    """key, text: chosen (key, text) with the rates that other texts (key, ord, text) of the key have and it lacks."""
    have = chosen.select("key", F.explode(F.regexp_extract_all("text", F.lit(r"\$\s?\d+(?:\.\d{2})?"), F.lit(0))).alias("a")).select("key", F.replace("a", F.lit(" "), F.lit("")).alias("amount")).distinct()
    new = rate_rows(texts).join(have, ["key", "amount"], "left_anti")
    new = new.groupBy("key", F.lower("label").alias("_l"), "amount").agg(F.min(F.struct("ord", "pos", "label")).alias("f"))
    lines = new.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("f.ord", "f.pos", F.concat_ws(" ", "f.label", "amount").alias("line")))).alias("rows"))
    joined = chosen.join(lines, "key", "left")
    more = F.concat(F.rtrim("text"), F.lit("\nShipping rates: "), F.array_join(F.col("rows.line"), "; "), F.lit("."))
    return joined.select("key", F.when(F.col("rows").isNotNull(), more).otherwise(F.col("text")).alias("text"))


def content_blocks(pages: DataFrame) -> DataFrame:
    """page_id, pos, block, text: content containers of a page (page_id, html) without its chrome, each with all its text, also
    that of containers inside it and behind them; pos is where it opens. The body, or a page without one as a whole, is
    the last.

    A container closes with the first closing tag of its name at its own depth (a running sum over the page's tags of that
    name); one that is never closed goes on to the end, and a closing tag without an opening one closes nothing.
    """
    tag = rf"(?is)</?(?:{CONTENT_TAGS})\b[^>]*>"
    bare = pages.select("page_id", F.regexp_replace("html", rf"(?is)<({CHROME_TAGS})\b.*?</\1>", " ").alias("html"))
    # gaps[k] lies in front of tags[k]; the last one behind all
    cut = bare.select("page_id", F.regexp_extract_all("html", F.lit(tag), F.lit(0)).alias("tags"), F.split("html", tag).alias("gaps"))
    each = cut.select("page_id", F.posexplode("tags").alias("at", "tag"))
    each = each.select("page_id", "at", F.lower(F.regexp_extract("tag", r"^</?(\w+)", 1)).alias("name"), (~F.startswith("tag", F.lit("</"))).alias("opens"))
    of_name = Window.partitionBy("page_id", "name").orderBy("at")
    depth = F.sum(F.when(F.col("opens"), 1).otherwise(-1)).over(of_name)
    each = each.withColumn("depth", F.when(F.col("opens"), depth).otherwise(depth + 1))
    # tags of a name and depth take turns: what comes behind an opening one closes it
    turn = Window.partitionBy("page_id", "name", "depth").orderBy("at")
    spans = each.withColumn("next", F.lead(F.when(~F.col("opens"), F.col("at"))).over(turn)).where("opens")
    spans = spans.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("at", "next"))).alias("spans"))  # a page's own
    text = lambda x: F.array_join(F.slice("gaps", x["at"] + 2, F.coalesce(x["next"], F.size("tags")) - x["at"]), " ")
    blocks = cut.join(spans, "page_id").select("page_id", F.explode("spans").alias("x"), "tags", "gaps").select("page_id", F.col("x.at").alias("pos"), F.lit(True).alias("block"), text(F.col("x")).alias("html"))
    body = F.coalesce(F.nullif(F.regexp_extract("html", r"(?is)<body\b[^>]*>(.*)", 1), F.lit("")), F.col("html"))
    rows = blocks.unionByName(bare.select("page_id", F.lit(None).cast("int").alias("pos"), F.lit(False).alias("block"), body.alias("html")))
    return rows.select("page_id", "pos", "block", squash(F.regexp_replace("html", "<[^>]+>", " ")).alias("text"))


def content_text(pages: DataFrame, signals: str, nav: str) -> DataFrame:
    """page_id, text: the blocks with a policy score, in order, less those inside a longer one, each once and joined by
    blank lines; the body's text where none scores; null where that is empty."""
    rows = content_blocks(pages).withColumn("score", T.candidate_score(F.col("text"), signals, nav))
    strong = rows.where("block AND score > 0").groupBy("page_id", "text").agg(F.min("pos").alias("pos"))
    kept = strong.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("all"))  # a page's own blocks
    inside = lambda x: F.exists("all", lambda y: (F.length(y["text"]) > F.length(x["text"])) & F.contains(y["text"], x["text"]))
    joined = kept.select("page_id", F.array_join(F.transform(F.filter("all", lambda x: ~inside(x)), lambda x: x["text"]), "\n\n").alias("strong"))
    body = rows.where("NOT block").select("page_id", F.nullif(F.col("text"), F.lit("")).alias("body"))
    return body.join(joined, "page_id", "left").select("page_id", F.coalesce("strong", "body").alias("text"))


@dataclass(frozen=True)
class Vocabulary:
    """Patterns of a language: policy signals, navigation, words of shipping and returns (a category's keyword too), and
    where a returns section starts, stops and ends, a shipping window starts, and page chrome follows."""

    signals: str
    nav: str
    shipping: str
    returns: str
    section: str
    stop: str
    edge: str
    anchor: str
    chrome: str

    def of(self, category: str) -> str:
        return self.shipping if category == "shipping" else self.returns


def accepted(text: Column, category: str, words: Vocabulary, least: int) -> Column:
    """Whether a page's text is a policy of a category: long enough, with its keyword and policy phrasing, not legal."""
    return F.coalesce((F.length(text) >= least) & text.rlike(words.of(category)) & T.looks_like_policy(text, words.signals, words.nav) & ~T.legal_page(text), F.lit(False))


def capture(sites: DataFrame, pages: DataFrame, homes: DataFrame, terms: DataFrame, words: Vocabulary, least: int = 200, first: int = 3, cap: int = 4000) -> DataFrame:
    """site, text, urls (null where nothing is found) for every site: its returns and shipping policies.

    pages: site, category, ord, url, text (its content block) and page (all its visible text; may be left out, then the
    text) of landed candidates; homes: site, url, text of home pages; terms: site, ord,
    url, text of legal pages. For a category, of the first accepted candidates the one of best score, for shipping with
    the rates that the others have; else the home page, if it is accepted; for returns, else the returns section of the
    first legal page that has one. A shipping text that hardly speaks of shipping is replaced by the shipping window of its
    page, if that does better. Same page and text: once, with a double budget; else labelled sections of `cap` each.
    """
    own = {}
    pages = pages if "page" in pages.columns else pages.withColumn("page", F.col("text"))
    for category in CATEGORIES:
        score = T.candidate_score(F.col("text"), words.signals, words.nav, words.shipping if category == "shipping" else None)
        rows = pages.where(F.col("category") == category).withColumn("accepted", accepted(F.col("text"), category, words, least)).withColumn("score", score)
        best = best_page(rows, ["site"], first).select("site", "url", "text", "page")
        if category == "shipping":
            early = rows.where("accepted").withColumn("_k", F.row_number().over(Window.partitionBy("site").orderBy("ord"))).where(F.col("_k") <= first)
            merged = rate_merge(best.select(F.col("site").alias("key"), "text"), early.select(F.col("site").alias("key"), "ord", "text"))
            best = best.drop("text").join(merged.withColumnRenamed("key", "site"), "site")
        home = homes.where(accepted(F.col("text"), category, words, least)).select("site", F.col("url").alias("home_url"), F.col("text").alias("home"))
        best = sites.select("site").join(best, "site", "left").join(home, "site", "left")
        own[category] = best.select("site", F.when(F.col("text").isNotNull(), F.col("url")).otherwise(F.col("home_url")).alias("url"), F.coalesce("text", "home").alias("text"), F.coalesce("page", "home").alias("page"))
    section = T.returns_section(F.col("text"), words.section, words.returns, words.stop, words.edge)
    legal = first_by(terms.select("site", "ord", F.col("url").alias("legal_url"), section.alias("legal")).where("legal IS NOT NULL"), ["site"], F.col("ord"))
    returns = own["returns"].join(legal, "site", "left").select("site", F.when(F.col("text").isNotNull(), F.col("url")).otherwise(F.col("legal_url")).alias("returns_url"), F.coalesce("text", "legal").alias("returns"))
    hits = lambda c, pattern: F.regexp_count(c, F.lit(pattern))
    ship, back = hits(F.col("text"), words.shipping), hits(F.col("text"), words.returns)
    window = T.shipping_window(F.col("page"), words.anchor, words.chrome, words.shipping, words.returns)
    repaired = F.when(((ship < 2) | (back > ship)) & (hits(window, words.shipping) > ship), window).otherwise(F.col("text"))
    shipping = own["shipping"].select("site", F.col("url").alias("shipping_url"), repaired.alias("shipping"))
    both = returns.join(shipping, "site")
    same = F.col("returns_url").eqNullSafe(F.col("shipping_url")) & F.col("returns").eqNullSafe(F.col("shipping")) & F.col("returns").isNotNull()
    part = lambda name: F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{name.upper()}:\n"), F.left(T.category_text(F.col(name), name, words.shipping, words.returns), F.lit(cap))))
    text = F.when(same, F.concat(F.lit("SHIPPING & RETURNS:\n"), F.left("returns", F.lit(2 * cap)))).otherwise(F.nullif(F.concat_ws("\n\n", part("returns"), part("shipping")), F.lit("")))
    urls = F.when(same, F.col("returns_url")).otherwise(F.nullif(F.concat_ws(" | ", F.when(F.col("returns").isNotNull(), F.col("returns_url")), F.when(F.col("shipping").isNotNull(), F.col("shipping_url"))), F.lit("")))
    return both.select("site", text.alias("text"), urls.alias("urls"))


def recapture(stored: DataFrame, found: DataFrame, key: str, words: Vocabulary, clear_unfixable: bool = False, only_broken: bool = False) -> DataFrame:
    """key, action, policy for stored (key, policy) and found (key, text): write what was found (refresh, where a good one
    was stored); else clear a weak one, if opted in; else leave. With only_broken, weak ones alone are looked at."""
    rows = stored.select(key, "policy", F.coalesce(T.policy_weak(F.col("policy"), words.signals, words.nav), F.lit(True)).alias("_weak"))
    rows = rows.where("_weak") if only_broken else rows
    rows = rows.join(found.select(key, "text"), key, "left")
    action = F.when(F.col("text").isNotNull(), F.when(F.col("_weak"), "write").otherwise("refresh")).when(F.col("_weak") & F.lit(clear_unfixable), "clear").otherwise("leave")
    return rows.select(key, action.alias("action"), F.when(F.col("text").isNotNull(), F.col("text")).when(action != "clear", F.col("policy")).alias("policy"))
