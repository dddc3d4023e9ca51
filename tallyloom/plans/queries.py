"""Registered queries: each is the operator over a fixture view, and the same in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import catalog as C
from ..operators import identity as I
from ..operators import reconcile as R
from ..operators import rules as Q
from ..operators import scoring as S
from ..sources import seeds as A
from ..sources.scratch import scratch_path
from .fixtures import Views, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The vocabulary that the synthetic names and texts have.
# (Without word boundaries, on which the two engines' regular expressions differ beyond ASCII.)
SIGNALS = r"the|and|of|to|with|from|this|are|que|der|los"
NAV = r"(?i)license"
SHIP, RETURN = r"(?i)to|of|en", r"(?i)the|de"
CATEGORIES, GUARD, BEAUTY = "ring|plate|widget|rod", "large", "PROMO"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def add(f: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLES[name] = oracle(views, sql)
        return f

    return add


DOMAIN = "regexp_replace(regexp_extract(lower({}), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^www\\.', '')"


def dom(x: str) -> str:
    return DOMAIN.format(x)


# --- urls and labels ---------------------------------------------------------------------------------------------


@query("normalize_url", "SELECT ord, regexp_extract(store_url, '^([^:]+://[^/?#]*)', 1) AS site FROM seeds", ("seeds",))
def _(v):
    return v.seeds.select("ord", U.normalize_url(F.col("store_url")).alias("site"))


@query("domain_key", f"SELECT ord, {dom('store_url')} AS domain FROM seeds", ("seeds",))
def _(v):
    return v.seeds.select("ord", U.domain_key(F.col("store_url")).alias("domain"))


@query("canonical_website", f"SELECT id, concat('https://', {dom('website')}) AS website FROM stores", ("stores",))
def _(v):
    return v.stores.select("id", U.canonical_website(F.col("website")).alias("website"))


@query("clean_optional", "SELECT id, nullif(trim(coalesce(address, '  ')), '') AS address FROM stores", ("stores",))
def _(v):
    return v.stores.select("id", U.clean_optional(F.coalesce("address", F.lit("  "))).alias("address"))


@query("image_key", "SELECT store_id, product_id, array_to_string(list_transform(images, lambda u: split_part(u, '?', 1)), ' ') AS keys FROM products", ("products",))
def _(v):
    return v.products.select("store_id", "product_id", F.array_join(U.image_keys(F.col("images")), " ").alias("keys"))


@query("loose_casts", "SELECT user_id, event_id, CASE event_id % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN NULL WHEN 3 THEN true WHEN 4 THEN false END AS b, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS i FROM events")
def _(v):
    e = v.events
    word = F.element_at(F.array(*map(F.lit, (" YES ", "off", "maybe", "1", "N", ""))), (F.col("event_id") % 6 + 1).cast("int"))
    number = F.concat(F.lit(" "), F.col("event_id").cast("string"), F.when(F.col("event_id") % 3 == 0, ".5").otherwise(" "))
    return e.select("user_id", "event_id", T.loose_bool(word).alias("b"), T.loose_int(number).alias("i"))


@query("price_cents", "SELECT p_partkey, CAST(round(CAST(p_retailprice AS DECIMAL(38,6)) * 100, 0) AS BIGINT) AS cents FROM part")
def _(v):
    return v.part.select("p_partkey", T.price_cents(F.concat(F.lit(" "), F.col("p_retailprice").cast("string"))).alias("cents"))


@query("gender_token", "SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'female' WHEN 1 THEN 'male' WHEN 2 THEN 'unisex' WHEN 3 THEN 'unisex' WHEN 4 THEN 'female' WHEN 5 THEN 'male' END AS label FROM part")
def _(v):
    word = F.element_at(F.array(*map(F.lit, ("Women's", "mens_wear", "All-Gender tops", "gender neutral", "for-girls", " BOYS ", "sale"))), (F.col("p_partkey") % 7 + 1).cast("int"))
    return v.part.select("p_partkey", T.gender_token(word).alias("label"))


@query("product_url", "SELECT store_id, product_id, CASE pid % 3 WHEN 0 THEN concat('https://shop', shop_no, '.example.com/products/item-', product_id) WHEN 1 THEN concat('https://shop', shop_no, '.example.com/p/', product_id) ELSE concat('https://other.example.org/', product_id) END AS url FROM products", ("products",))
def _(v):
    base = F.concat(F.lit("https://shop"), "shop_no", F.lit(".example.com"))
    explicit = F.when(F.col("pid") % 3 == 1, F.concat(F.lit("/p/"), "product_id")).when(F.col("pid") % 3 == 2, F.concat(F.lit("https://other.example.org/"), "product_id"))
    return v.products.select("store_id", "product_id", U.product_url(explicit, F.concat(F.lit("/item-"), "product_id"), base).alias("url"))


@query("object_path", "SELECT store_id, product_id, i, concat(product_id, '-', i, '.jpg?v=', store_id - 1) AS path, concat(product_id, '-', i, '.jpg') AS file FROM image_verdicts", ("image_verdicts",))
def _(v):
    url = F.col("url")
    return v.image_verdicts.select("store_id", "product_id", "i", U.object_path(url, "https://cdn.example.com/").alias("path"), U.file_name(url).alias("file"))


@query("hash_shard", "SELECT website, CAST(list_reduce(list_prepend(0, list_transform(range(1, 65), lambda k: instr('0123456789abcdef', substr(sha256(website), k, 1)) - 1)), lambda a, d: (a * 16 + d) % 7) AS INTEGER) AS shard FROM (SELECT DISTINCT website FROM stores)", ("stores",))
def _(v):
    return v.stores.select("website").distinct().select("website", U.hash_shard(F.col("website"), 7).alias("shard"))


@query("short_message", "SELECT run_id, website, CASE WHEN length(m) > 40 THEN concat(substr(m, 1, 37), '...') ELSE m END AS m FROM (SELECT run_id, website, repeat(coalesce(error, 'fine '), 6) AS m FROM runs)", ("runs",))
def _(v):
    return v.runs.select("run_id", "website", T.short_message(F.repeat(F.coalesce("error", F.lit("fine ")), 6), 40).alias("m"))


@query("progress_eta", "SELECT run_id, done, total, CASE WHEN s >= 3600 THEN concat(s // 3600, 'h', lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0'), 'm') WHEN s >= 60 THEN concat(s // 60, 'm', lpad(CAST(s % 60 AS VARCHAR), 2, '0'), 's') ELSE concat(s, 's') END AS text FROM (SELECT run_id, count(*) FILTER (status <> 'pending') AS done, count(*) AS total, count(*) FILTER (status = 'pending') * 37 AS s FROM runs GROUP BY run_id)", ("runs",))
def _(v):
    pending = F.count_if(F.col("status") == "pending")
    return v.runs.groupBy("run_id").agg(F.count_if(F.col("status") != "pending").alias("done"), F.count("*").alias("total"), T.duration_text(pending * 37).alias("text"))


@query("iso_timestamp", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS seen FROM events")
def _(v):
    text = F.when(F.col("event_id") % 5 == 0, "soon").otherwise(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return v.events.select("event_id", F.try_to_timestamp(text).cast("timestamp_ntz").alias("seen"))


# --- page text ---------------------------------------------------------------------------------------------------


@query("page_source", "SELECT page_id, length(html) AS chars FROM pages")
def _(v):
    return v.pages.select("page_id", F.length("html").cast("bigint").alias("chars"))


def _visible_sql(x: str) -> str:
    for t in T.HIDDEN_TAGS:
        x = f"regexp_replace({x}, '(?is)<{t}\\b.*?</{t}>', ' ', 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for entity, char in T.ENTITIES.items():
        x = "replace({}, '{}', '{}')".format(x, entity, char.replace("'", "''"))
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query("visible_text", f"SELECT page_id, {_visible_sql('html')} AS text FROM pages")
def _(v):
    return v.pages.select("page_id", T.visible_text(F.col("html")).alias("text"))


TITLE_SQL = "trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
ADDRESS_SQL = "nullif(trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<address[^>]*>(.*?)</address>', 1), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), '')"


@query("classify_store", f"""SELECT page_id, title, address, CASE WHEN online THEN handle END AS handle, CASE WHEN online THEN 'online' ELSE 'offline' END AS store_type, CASE WHEN signal THEN 'online' ELSE 'offline' END AS strict_type
FROM (SELECT *, signal OR address IS NULL AS online FROM (SELECT page_id, coalesce(nullif({TITLE_SQL}, ''), url) AS title, {ADDRESS_SQL} AS address, nullif(trim(regexp_extract(html, '(?i)instagram\\.com/([A-Za-z0-9_.-]+)', 1), '/@ '), '') AS handle,
  contains(lower(html), '/cart') OR contains(lower(html), '/checkout') OR contains(lower(html), 'add-to-cart') OR contains(lower(html), 'products') AS signal
  FROM (SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN concat('<address><b>', page_id, '</b> Main St</address><a href="https://instagram.com/p', page_id, '/">', html) WHEN page_id % 5 = 0 THEN replace(html, '<title>', '<p>') ELSE html END AS html FROM pages)))""")
def _(v):
    # the given pages have no addresses or handles: every third gets both, some others lose their title
    html = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<address><b>"), "page_id", F.lit('</b> Main St</address><a href="https://instagram.com/p'), "page_id", F.lit('/">'), "html")).when(F.col("page_id") % 5 == 0, F.replace("html", F.lit("<title>"), F.lit("<p>"))).otherwise(F.col("html"))
    rows = v.pages.select("page_id", "url", html.alias("html"))
    return rows.select("page_id", T.store_profile(F.col("html"), F.col("url")).alias("p"), T.store_profile(F.col("html"), F.col("url"), True)["store_type"].alias("strict_type")).select("page_id", "p.*", "strict_type")


QUERIES["social_handle"] = lambda spark, sf_dir: Views(spark, sf_dir).pages.select("page_id", T.social_handle(F.col("html")).alias("handle"))
ORACLES["social_handle"] = "SELECT page_id, nullif(trim(regexp_extract(html, '(?i)instagram\\.com/([A-Za-z0-9_.-]+)', 1), '/@ '), '') AS handle FROM pages"

COUNT_SQL = "len(list_distinct(list_transform(regexp_extract_all(text, '" + SIGNALS + "'), lambda x: lower(x))))"
LOOKS_SQL = f"({COUNT_SQL} >= 2 OR ({COUNT_SQL} = 1 AND length(text) <= 800 AND NOT regexp_matches(text, '{NAV}')))"
LEGAL_SQL = "(NOT regexp_matches(regexp_replace(ltrim(text), '^[A-Z][A-Z &]+:\\s*', ''), '" + T.POLICY_LEAD + "') AND regexp_matches(substr(regexp_replace(ltrim(text), '^[A-Z][A-Z &]+:\\s*', ''), 1, 200), '" + T.EXCLUDED_PAGE_WORDS + "'))"


@query("signal_count", f"SELECT doc_id, CAST({COUNT_SQL} AS INTEGER) AS n FROM documents")
def _(v):
    return v.documents.select("doc_id", T.signal_count(F.col("text"), SIGNALS).alias("n"))


@query("looks_like_policy", f"SELECT doc_id, {LOOKS_SQL} AS yes FROM documents")
def _(v):
    return v.documents.select("doc_id", T.looks_like_policy(F.col("text"), SIGNALS, NAV).alias("yes"))


@query("legal_page", f"SELECT doc_id, {LEGAL_SQL} AS yes FROM documents")
def _(v):
    return v.documents.select("doc_id", T.legal_page(F.col("text")).alias("yes"))


SCORE_SQL = f"CASE WHEN {COUNT_SQL} < 2 THEN 0.0 ELSE {COUNT_SQL} / greatest(1.0, length(text) / 1000.0) * CASE WHEN regexp_matches(substr(text, 1, 400), '{NAV}') THEN 0.1 ELSE 1.0 END * (1.0 + least(len(regexp_extract_all(text, '{SHIP}')), 12) / 2.0) END"


@query("candidate_score", f"SELECT doc_id, round(CAST({SCORE_SQL} AS DOUBLE), 6) AS score FROM documents")
def _(v):
    return v.documents.select("doc_id", F.round(T.candidate_score(F.col("text"), SIGNALS, NAV, SHIP).cast("double"), 6).alias("score"))


WEAK_SQL = f"CASE WHEN trim(text) = '' OR {LEGAL_SQL} OR NOT {LOOKS_SQL} THEN true WHEN length(text) <= 800 OR {COUNT_SQL} / (length(text) / 1000.0) >= 2.0 THEN false ELSE regexp_matches(substr(text, 1, 400), '{NAV}') END"


@query("policy_weak", f"SELECT doc_id, {WEAK_SQL} AS weak FROM documents")
def _(v):
    return v.documents.select("doc_id", T.policy_weak(F.col("text"), SIGNALS, NAV).alias("weak"))


def _category_sql(text: str, first: str, second: str, least: int) -> str:
    """Of a text in blocks, those with as many hits of the first pattern as of the second (and `least` of them), or with least 0 more."""
    ahead = f"len(regexp_extract_all(x, '{first}'))"
    keep = f"{ahead} >= {least} AND {ahead} >= len(regexp_extract_all(x, '{second}'))" if least else f"{ahead} > len(regexp_extract_all(x, '{second}'))"
    blocks = f"list_filter(list_transform(string_split({text}, chr(10) || chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13) || chr(12))), lambda x: x <> '')"
    return f"CASE WHEN len({blocks}) <= 1 THEN {text} ELSE coalesce(nullif(array_to_string(list_filter({blocks}, lambda x: {keep}), chr(10) || chr(10)), ''), {text}) END"


@query("category_text", f"SELECT doc_id, md5({_category_sql('t', SHIP, RETURN, 2)}) AS digest FROM (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents)")
def _(v):
    t = F.regexp_replace("text", r"\n", "\n\n")
    return v.documents.select("doc_id", F.md5(T.category_text(t, "shipping", SHIP, RETURN)).alias("digest"))


_TRIMMED = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_PARTS = "regexp_extract_all({0}, '{1}') AS found, regexp_split_to_array({0}, '{1}') AS gaps"


def section_sql(rows: str, key: str) -> str:
    """key, section (null: none) of rows (key, text, ...)."""
    return f"""(WITH a AS (SELECT {key}, substr(text, length(regexp_split_to_array(text, '(?i)that|que|ein')[1]) + 1) AS section FROM {rows} WHERE regexp_matches(text, '(?i)that|que|ein')),
h AS (SELECT {key}, section, {_PARTS.format("section", RETURN)} FROM a),
m AS (SELECT *, coalesce(list_min(list_filter(range(2, len(found) + 1), lambda k: length(gaps[k]) > 900 OR regexp_matches(gaps[k], '(?i)with|avec|mit'))) - 1, len(found)) AS m FROM h),
r AS (SELECT {key}, section, CAST(coalesce(list_sum(list_transform(range(1, m + 1), lambda k: length(gaps[k]) + length(found[k]))), 0) AS BIGINT) AS run FROM m),
e AS (SELECT *, substr(section, run + 1) AS rest FROM r), f AS (SELECT *, {_TRIMMED.format("substr(substr(section, 1, run + CASE WHEN regexp_matches(rest, '(?i)with|from|avec|mit') THEN least(length(regexp_split_to_array(rest, '(?i)with|from|avec|mit')[1]), 120) ELSE 120 END), 1, 4000)")} AS cut FROM e)
SELECT {key}, CASE WHEN run > 0 AND length(cut) >= 80 THEN cut END AS section FROM {rows} LEFT JOIN f USING ({key}))"""


def window_sql(rows: str, key: str) -> str:
    """key, part (null: none) of rows (key, text, ...)."""
    return f"""(WITH h AS (SELECT {key}, text, {_PARTS.format("text", "(?i)from|que|ein")} FROM {rows}),
s AS (SELECT {key}, text, unnest(list_transform(range(1, len(found) + 1), lambda k: CAST(list_sum(list_transform(range(1, k + 1), lambda j: length(gaps[j]))) + coalesce(list_sum(list_transform(range(1, k), lambda j: length(found[j]))), 0) AS BIGINT))) AS start FROM h),
w AS (SELECT {key}, start, {_TRIMMED.format("regexp_split_to_array(substr(text, start + 1, 3200), '(?i)license')[1]")} AS part FROM s),
k AS (SELECT {key}, arg_min(part, start) AS part FROM w WHERE len(regexp_extract_all(part, '{SHIP}')) >= 3 AND len(regexp_extract_all(part, '{SHIP}')) >= len(regexp_extract_all(part, '{RETURN}')) GROUP BY {key})
SELECT {key}, substr(part, 1, 4000) AS part FROM {rows} LEFT JOIN k USING ({key}))"""


@query("legal_returns_section", f"SELECT * FROM {section_sql('documents', 'doc_id')}")
def _(v):
    return v.documents.select("doc_id", T.returns_section(F.col("text"), r"(?i)that|que|ein", RETURN, r"(?i)with|avec|mit", r"(?i)with|from|avec|mit").alias("section"))


@query("shipping_window", f"SELECT * FROM {window_sql('documents', 'doc_id')}")
def _(v):
    return v.documents.select("doc_id", T.shipping_window(F.col("text"), r"(?i)from|que|ein", r"(?i)license", SHIP, RETURN).alias("part"))


@query("geocode_score", "SELECT c_custkey, provider, CASE WHEN found IS NULL THEN 0 ELSE CASE WHEN (c_custkey + provider) % 90 = c_custkey % 90 THEN 2 ELSE 0 END + 1 END AS score FROM geocode_candidates", ("geocode_candidates",))
def _(v):
    a = F.col("address")
    return v.geocode_candidates.select("c_custkey", "provider", T.geocode_score(T.zip_code(a), T.house_number(a), F.col("found")).alias("score"))


@query("geocode_pick", """SELECT address, provider, lat FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY CASE WHEN sure THEN 0 ELSE 1 END, CASE WHEN sure THEN 0 ELSE -s END, provider, c_custkey) AS rn
FROM (SELECT *, plain OR s >= 2 AS sure FROM (SELECT c_custkey % 5 = 0 AS plain, c_custkey, provider, lat, found, CASE WHEN c_custkey % 5 = 0 THEN split_part(address, ',', 1) ELSE address END AS address, CASE WHEN (c_custkey + provider) % 90 = c_custkey % 90 THEN 2 ELSE 0 END + 1 AS s FROM geocode_candidates WHERE found IS NOT NULL))) WHERE rn = 1""", ("geocode_candidates",))
def _(v):
    address = F.when(F.col("c_custkey") % 5 == 0, F.split_part("address", F.lit(","), F.lit(1))).otherwise(F.col("address"))
    return I.geocode_pick(v.geocode_candidates.withColumn("address", address)).select("address", "provider", "lat")


# --- stores and seeds --------------------------------------------------------------------------------------------

SEEDS = f"s AS (SELECT *, {dom('store_url')} AS domain, len(addresses) AS n FROM seeds), dd AS (SELECT min(ord) OVER (PARTITION BY domain) AS first_ord, domain, ord, store_url, store_name, addresses, n, row_number() OVER (PARTITION BY domain ORDER BY n DESC, ord) AS rn FROM s), picked AS (SELECT * FROM dd WHERE rn = 1)"
STORES = f"st AS (SELECT *, {dom('website')} AS domain FROM stores)"


@query("dedupe_domain", f"WITH {SEEDS} SELECT first_ord, domain, store_url, store_name, array_to_string(addresses, '|') AS addresses FROM picked", ("seeds",))
def _(v):
    return I.dedupe_domain(v.seeds).select("first_ord", "domain", "store_url", "store_name", F.array_join("addresses", "|").alias("addresses"))


@query("seed_addresses", "SELECT ord, array_to_string(addresses, '|') AS addresses FROM seeds", ("seeds",))
def _(v):
    twice = F.concat(F.array(F.lit("")), F.col("addresses"), F.transform("addresses", F.upper), F.array(F.lit(None).cast("string")))
    return v.seeds.select("ord", F.array_join(I.seed_addresses(twice), "|").alias("addresses"))


@query("distinct_websites", "SELECT DISTINCT website FROM stores", ("stores",))
def _(v):
    return v.stores.select("website").distinct()


@query("distinct_on", f"WITH {STORES} SELECT domain, arg_min(id, id) AS id, arg_min(store_name, id) AS store_name FROM st GROUP BY domain", ("stores",))
def _(v):
    return I.first_by(v.stores.withColumn("domain", U.domain_key(F.col("website"))), ["domain"], F.col("id")).select("domain", "id", "store_name")


def _shop_seeds(v):
    """Seeds of the shops' own domains: a url for each website, with addresses of its units."""
    s = v.stores
    return s.select(F.col("id").alias("ord"), F.concat("website", F.lit("/x")).alias("store_url"), "store_name", F.when(F.col("id") % 3 == 0, F.array(F.concat(F.lit("Seed "), "id"))).otherwise(F.array().cast("array<string>")).alias("addresses"))


SHOP_SEEDS = "shop_seeds AS (SELECT id AS ord, concat(website, '/x') AS store_url, store_name, CASE WHEN id % 3 = 0 THEN [concat('Seed ', id)] ELSE [] END AS addresses FROM stores)"
SHOP_PICKED = f"{SHOP_SEEDS}, sp AS (SELECT *, {dom('store_url')} AS domain FROM shop_seeds), spk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY len(addresses) DESC, ord) AS rn FROM sp) WHERE rn = 1)"


@query("address_backfill", f"WITH {STORES}, {SHOP_PICKED}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY id) AS rn FROM st) WHERE rn = 1 AND address IS NULL) SELECT f.id, f.domain, spk.addresses[1] AS new_address FROM f JOIN spk ON f.domain = spk.domain WHERE len(spk.addresses) > 0", ("stores",))
def _(v):
    return I.address_backfill(v.stores, I.dedupe_domain(_shop_seeds(v)))


@query("db_first_seeds", f"WITH {STORES}, {SHOP_PICKED}, {SEEDS}, u AS (SELECT domain, store_url, addresses FROM spk UNION ALL SELECT domain, store_url, addresses FROM picked), k AS (SELECT domain, min(website) AS website, min(address) AS address FROM st GROUP BY domain) SELECT 0 AS part, k.domain, k.website AS store_url, array_to_string(CASE WHEN len(u.addresses) > 0 THEN u.addresses WHEN k.address IS NOT NULL THEN [k.address] ELSE [] END, '|') AS addresses FROM k LEFT JOIN u ON k.domain = u.domain UNION ALL SELECT 1, domain, store_url, array_to_string(addresses, '|') FROM u WHERE domain NOT IN (SELECT domain FROM k)", ("stores", "seeds"))
def _(v):
    seeds = I.dedupe_domain(_shop_seeds(v)).unionByName(I.dedupe_domain(v.seeds))
    return I.db_first_seeds(v.stores, seeds).withColumn("addresses", F.array_join("addresses", "|"))


@query("first_unseen", f"WITH {STORES}, {SEEDS} SELECT first_ord, domain FROM picked WHERE domain NOT IN (SELECT domain FROM st) ORDER BY first_ord LIMIT 1", ("stores", "seeds"))
def _(v):
    known = v.stores.select(U.domain_key(F.col("website")).alias("domain"))
    return I.dedupe_domain(v.seeds).join(known, "domain", "left_anti").orderBy("first_ord").limit(1).select("first_ord", "domain")


@query("resume_eligible", "SELECT id, website FROM stores WHERE website IN (SELECT website FROM runs WHERE run_id = '1-URGENT' AND status IN ('pending', 'failed'))", ("stores", "runs"))
def _(v):
    open_runs = v.runs.where("run_id = '1-URGENT' AND status IN ('pending', 'failed')")
    return v.stores.join(open_runs, "website", "left_semi").select("id", "website")


@query("branch_fanout", f"WITH {SEEDS} SELECT domain, store_url, CAST(0 AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS address, true AS is_primary FROM picked WHERE len(addresses) = 0 UNION ALL SELECT domain, store_url, CAST(k - 1 AS INTEGER), addresses[k], k = 1 FROM (SELECT *, unnest(range(1, len(addresses) + 1)) AS k FROM picked)", ("seeds",))
def _(v):
    return I.branch_fanout(I.dedupe_domain(v.seeds))


BRANCHES = f"br AS (SELECT domain, CAST(k AS INTEGER) AS pos, CASE WHEN k = 0 THEN NULL ELSE concat('Unit ', k + shop_no % 2) END AS address FROM (SELECT DISTINCT {dom('website')} AS domain, shop_no FROM stores WHERE shop_no % 5 <> 4), (SELECT unnest(range(0, 5)) AS k) WHERE k < 2 + shop_no % 4)"


def _branches(v):
    shops = v.stores.where("shop_no % 5 <> 4").select(U.domain_key(F.col("website")).alias("domain"), "shop_no").distinct()
    rows = shops.withColumn("pos", F.explode(F.expr("sequence(0, CAST(1 + shop_no % 4 AS INT))")))
    return rows.select("domain", "pos", F.when(F.col("pos") > 0, F.concat(F.lit("Unit "), F.col("pos") + F.col("shop_no") % 2)).alias("address"))


@query("branch_assign", f"""WITH {STORES}, {BRANCHES}, b AS (SELECT *, row_number() OVER (PARTITION BY domain, address ORDER BY pos) AS rk FROM br), e AS (SELECT domain, id, address, row_number() OVER (PARTITION BY domain, address ORDER BY id) AS rk FROM st),
m AS (SELECT coalesce(b.domain, e.domain) AS domain, b.pos, b.address, e.id FROM b FULL JOIN e ON b.domain = e.domain AND b.address IS NOT DISTINCT FROM e.address AND b.rk = e.rk),
fb AS (SELECT domain, pos, address, row_number() OVER (PARTITION BY domain ORDER BY pos) AS rk FROM m WHERE id IS NULL), fe AS (SELECT domain, id, row_number() OVER (PARTITION BY domain ORDER BY id) AS rk FROM m WHERE pos IS NULL)
SELECT domain, pos, address, id, 'keep' AS action FROM m WHERE pos IS NOT NULL AND id IS NOT NULL UNION ALL SELECT coalesce(fb.domain, fe.domain), fb.pos, fb.address, fe.id, CASE WHEN fb.pos IS NULL THEN 'stale' WHEN fe.id IS NULL THEN 'insert' ELSE 'reuse' END FROM fb FULL JOIN fe ON fb.domain = fe.domain AND fb.rk = fe.rk""", ("stores",))
def _(v):
    existing = v.stores.select(U.domain_key(F.col("website")).alias("domain"), "id", "address")
    return I.branch_assign(_branches(v), existing).select("domain", "pos", "address", "id", "action")


@query("sync_branches", f"""WITH {STORES}, {BRANCHES}, b AS (SELECT *, row_number() OVER (PARTITION BY domain, address ORDER BY pos) AS rk FROM br), e AS (SELECT domain, id, address, row_number() OVER (PARTITION BY domain, address ORDER BY id) AS rk FROM st WHERE domain IN (SELECT domain FROM br)),
m AS (SELECT coalesce(b.domain, e.domain) AS domain, b.pos, b.address, e.id FROM b FULL JOIN e ON b.domain = e.domain AND b.address IS NOT DISTINCT FROM e.address AND b.rk = e.rk),
fb AS (SELECT domain, pos, address, row_number() OVER (PARTITION BY domain ORDER BY pos) AS rk FROM m WHERE id IS NULL), fe AS (SELECT domain, id, row_number() OVER (PARTITION BY domain ORDER BY id) AS rk FROM m WHERE pos IS NULL),
a AS (SELECT domain, pos, id FROM m WHERE pos IS NOT NULL AND id IS NOT NULL UNION ALL SELECT fb.domain, fb.pos, fe.id FROM fb LEFT JOIN fe ON fb.domain = fe.domain AND fb.rk = fe.rk),
gone AS (SELECT st.id, a.id AS primary_id FROM st JOIN a ON st.domain = a.domain AND a.pos = 0 WHERE st.id NOT IN (SELECT id FROM a WHERE id IS NOT NULL) AND a.id IS NOT NULL)
SELECT store_id, product_id FROM products WHERE store_id NOT IN (SELECT id FROM gone) UNION SELECT primary_id, product_id FROM products JOIN gone ON store_id = gone.id""", ("stores", "products"))
def _(v):
    existing = v.stores.select(U.domain_key(F.col("website")).alias("domain"), "id", "address")
    branches = _branches(v)
    existing = existing.join(branches.select("domain").distinct(), "domain", "left_semi")
    plan = I.branch_assign(branches, existing)
    primary = plan.where("pos = 0 AND id IS NOT NULL").select("domain", F.col("id").alias("primary_id"))
    moves = plan.where("action = 'stale'").join(primary, "domain").select(F.col("id").alias("store_id"), "primary_id")
    return v.products.join(moves, "store_id", "left").select(F.coalesce("primary_id", "store_id").alias("store_id"), "product_id").distinct()


@query("size_lanes", f"SELECT domain, max(n) AS products, CASE WHEN max(n) >= 2070 THEN 'large' ELSE 'small' END AS lane FROM (SELECT {dom('website')} AS domain, website, count(product_id) AS n FROM stores LEFT JOIN products ON id = store_id GROUP BY ALL) GROUP BY domain", ("stores", "products"))
def _(v):
    return I.size_lanes(v.stores, v.products, 2070)


@query("domain_filter", f"WITH {STORES} SELECT id, website FROM st WHERE domain = 'shop3.example.com'", ("stores",))
def _(v):
    return v.stores.where(U.domain_key(F.col("website")) == "shop3.example.com").select("id", "website")


@query("seed_override", f"WITH {STORES}, {SHOP_PICKED} SELECT st.id, coalesce(spk.store_name, st.store_name) AS store_name, coalesce(spk.addresses[1], st.address) AS address FROM st LEFT JOIN spk ON st.domain = spk.domain", ("stores",))
def _(v):
    seeds = I.dedupe_domain(_shop_seeds(v)).select("domain", F.col("store_name").alias("seed_name"), F.try_element_at("addresses", F.lit(1)).alias("seed_address"))
    rows = v.stores.withColumn("domain", U.domain_key(F.col("website"))).join(seeds, "domain", "left")
    return rows.select("id", F.coalesce("seed_name", "store_name").alias("store_name"), F.coalesce("seed_address", "address").alias("address"))


def _seed_lines(v, name=None):
    """Cells of seed lines: every seventh with url and name swapped; names as they are, or as `name` says."""
    rows = v.seeds if name is None else v.seeds.withColumn("store_name", name)
    cells = F.when(F.col("ord") % 7 == 0, F.array("store_name", "store_url")).otherwise(F.array("store_url", "store_name"))
    return rows.select(F.concat(F.lit("part-"), F.col("ord") % 4).alias("file"), (F.col("ord") + 1).alias("line_no"), F.concat(cells, "addresses").alias("cells"))


SEED_ROWS = "SELECT concat('part-', ord % 4) AS file, ord + 1 AS line_no, regexp_extract(store_url, '^([^:]+://[^/?#]*)', 1) AS store_url, store_name, array_to_string(addresses, '|') AS addresses, true AS ok FROM seeds"
for _name in ("seed_header", "seed_swap_recovery"):

    @query(_name, SEED_ROWS, ("seeds",))
    def _(v, name=_name):
        rows = _seed_lines(v)
        if name == "seed_header":
            heads = v.spark.createDataFrame([(f"part-{k}", 0, ["Store URL", "Name", "Address"]) for k in range(4)], "file string, line_no int, cells array<string>")
            rows = rows.unionByName(heads)
        return A.parse_seeds(rows).withColumn("addresses", F.array_join("addresses", "|"))


@query("seed_scan", "SELECT regexp_extract(store_url, '^([^:]+://[^/?#]*)', 1) AS store_url, CASE ord % 3 WHEN 0 THEN concat(store_name, ' \"A\"', chr(9), 'B', chr(10), chr(10), 'C') ELSE store_name END AS store_name, array_to_string(addresses, '|') AS addresses, true AS ok FROM seeds", ("seeds",))
def _(v):
    path = scratch_path(v.spark, "seeds")
    # a third of the names holds quotes, tabs and line ends
    name = F.when(F.col("ord") % 3 == 0, F.concat(F.lit('"'), "store_name", F.lit(' ""A""\tB\n\nC"'))).otherwise(F.col("store_name"))
    _seed_lines(v, name).select(F.array_join("cells", "\t").alias("value")).write.text(path)
    return A.parse_seeds(A.lines(v.spark, path)).select("store_url", "store_name", F.array_join("addresses", "|").alias("addresses"), "ok")


@query("url_list", "SELECT ord, regexp_extract(store_url, '^([^:]+://[^/?#]*)', 1) AS store_url FROM seeds ORDER BY ord LIMIT 100", ("seeds",))
def _(v):
    return A.url_list(v.seeds.select("ord", F.concat_ws(",", "store_url", "store_name").alias("line")), 100)
