"""Catalog extraction: a page's JSON body to typed product rows, in one projection and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import gender_token, loose_bool, price_cents
from ..functions.urls import clean_optional, product_url

_VARIANT = "struct<price:string,sku:string,available:string,inventory_quantity:string,inventory_policy:string,option1:string,option2:string,option3:string>"
#: Every leaf a string: numbers, booleans and objects arrive as text and are cast one by one.
SCHEMA = (
    "products array<struct<id:string,title:string,handle:string,body_html:string,vendor:string,product_type:string,updated_at:string,price:string,price_min:string,"
    f"available:string,online_store_url:string,url:string,tags:string,gender:string,images:array<struct<src:string>>,options:array<struct<name:string,values:array<string>>>,variants:array<{_VARIANT}>>>"
)
# Option names and size labels.
SIZE_NAMES, COLOR_NAMES, GENDER_NAMES = "size", "color|colour", "gender|sex"
SIZE_LABEL = r"(?i)^(?:x{0,2}s|m|l|x{1,3}l)$|[0-9]"
# End of fixed values.
#: What a product is known by; and where it stands on its page as well (see first_seen_products).
PRODUCT, PLACE = ("domain", "product_id"), ("domain", "product_id", "pos")


def _array(x: Column, kind: str = "string") -> Column:
    return F.coalesce(x, F.array().cast(f"array<{kind}>"))


def parse_pages(pages: DataFrame) -> DataFrame:
    """pages (domain, page, http_status, body) with products: null where the body or its key is missing or broken."""
    return pages.withColumn("products", F.from_json("body", SCHEMA)["products"])


def explode_products(pages: DataFrame) -> DataFrame:
    """A row for each product (p) with its place on the page, without those whose id is missing, 0 or empty."""
    rows = parse_pages(pages).select("domain", "page", F.posexplode("products").alias("pos", "p"))
    return rows.where("p.id IS NOT NULL AND p.id NOT IN ('', '0')")


def image_list(p: Column) -> Column:
    return F.filter(F.transform(_array(p["images"], "struct<src:string>"), lambda i: i["src"]), lambda s: s != "")


def option_values(p: Column, names: str) -> Column:
    own = F.filter(_array(p["options"], "struct<name:string,values:array<string>>"), lambda o: F.coalesce(F.lower(o["name"]).rlike(names), F.lit(False)))
    return F.filter(F.flatten(F.transform(own, lambda o: _array(o["values"]))), lambda v: clean_optional(v).isNotNull())


def _variants(p: Column) -> Column:
    return _array(p["variants"], f"{_VARIANT}")


def sizes(p: Column) -> Column:
    """Values of size options, and variant options that look like sizes; sorted, each once."""
    options = F.flatten(F.transform(_variants(p), lambda v: F.array(v["option1"], v["option2"], v["option3"])))
    return F.sort_array(F.array_union(option_values(p, SIZE_NAMES), F.filter(options, lambda o: F.coalesce(o.rlike(SIZE_LABEL), F.lit(False)))))


def colors(p: Column) -> Column:
    return F.sort_array(F.array_distinct(option_values(p, COLOR_NAMES)))


def min_price(p: Column) -> Column:
    return F.coalesce(price_cents(p["price"]), price_cents(p["price_min"]), F.array_min(F.transform(_variants(p), lambda v: price_cents(v["price"]))))


def first_sku(p: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(_variants(p), lambda v: clean_optional(v["sku"])), lambda s: s.isNotNull()), F.lit(1))


def variant_signals(p: Column) -> Column:
    """Of each variant: available, not available or null (nothing said)."""
    return F.transform(_variants(p), lambda v: F.coalesce(loose_bool(v["available"]), F.when(F.lower(v["inventory_policy"]) == "continue", True), v["inventory_quantity"].try_cast("double") > 0))


def unavailable(p: Column) -> Column:
    """The product says so; or some variant says something and none says it is available."""
    said = F.filter(variant_signals(p), lambda s: s.isNotNull())
    return F.coalesce(~loose_bool(p["available"]), F.lit(False)) | ((F.size(said) > 0) & ~F.exists(said, lambda s: s))


def gender_label(p: Column) -> Column:
    """The first of: gender fields and gender options, tags, product type, title that names one."""
    first = lambda values: F.try_element_at(F.filter(F.transform(values, gender_token), lambda g: g.isNotNull()), F.lit(1))
    tags = F.split(F.regexp_replace(F.coalesce(p["tags"], F.lit("")), r'[\[\]"]', ""), ",")
    return F.coalesce(gender_token(p["gender"]), first(option_values(p, GENDER_NAMES)), first(tags), gender_token(p["product_type"]), gender_token(p["title"]))


def _typed(base: Column | None) -> list[Column]:
    p = F.col("p")
    where = base if base is not None else F.concat(F.lit("https://"), F.col("domain"))
    return [
        F.col("domain"), F.col("page"), F.col("pos"), p["id"].alias("product_id"), p["handle"].alias("handle"), F.coalesce(p["title"], F.lit("")).alias("item_name"),
        F.nullif(p["vendor"], F.lit("")).alias("brand"), clean_optional(p["product_type"]).alias("product_type"), p["updated_at"].alias("updated_at"),
        image_list(p).alias("images"), sizes(p).alias("sizes"), colors(p).alias("colors"), min_price(p).alias("price_cents"), first_sku(p).alias("sku"),
        unavailable(p).alias("unavailable"), gender_label(p).alias("gender_label"), product_url(F.coalesce(p["online_store_url"], p["url"]), p["handle"], where).alias("product_url"),
    ]


def extract_catalog(pages: DataFrame, base: Column | None = None) -> DataFrame:
    """Typed product rows of landed pages (domain, page, http_status, body)."""
    return explode_products(pages).select(*_typed(base))


def extract_walks(pages: DataFrame, base: Column | None = None) -> DataFrame:
    """All that a walk over landed pages tells, from one reading of their bodies: http_status, n_products (null: no key) and
    typed product rows; a page without products has one row, where product_id is null."""
    rows = parse_pages(pages).select("domain", "page", "http_status", F.when(F.col("products").isNotNull(), F.size("products")).alias("n_products"), F.posexplode_outer("products").alias("pos", "p"))
    return rows.select("http_status", "n_products", *_typed(base))


def listed_in(walks: DataFrame) -> DataFrame:
    """The rows of extract_catalog out of those of extract_walks."""
    return walks.where("product_id IS NOT NULL AND product_id NOT IN ('', '0')").drop("http_status", "n_products")


def walk_counts(walks: DataFrame) -> DataFrame:
    """page_counts out of the rows of extract_walks."""
    new = first_seen_products(listed_in(walks).select("domain", "page", "pos", "product_id")).groupBy("domain", "page").agg(F.count("*").alias("n_new"))
    rows = walks.where("coalesce(pos, 0) = 0").select("domain", "page", "http_status", "n_products")
    return rows.join(new, ["domain", "page"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))


def first_seen_products(rows: DataFrame, keys: tuple[str, ...] = PRODUCT) -> DataFrame:
    """The first row of each (domain, product_id) over the pages. With keys PLACE, of each place on a page: what a page that
    comes again lists is left out, but an id that stands at two places of a catalog stays at both, as rows of two products."""
    at = Window.partitionBy(*keys).orderBy("page", "pos")
    return rows.withColumn("_rank", F.row_number().over(at)).where("_rank = 1").drop("_rank")


def cap_after_filter(rows: DataFrame, cap: int) -> DataFrame:
    """The first rows of each domain."""
    at = Window.partitionBy("domain").orderBy("page", "pos")
    return rows.withColumn("_rank", F.row_number().over(at)).where(F.col("_rank") <= cap).drop("_rank")


def page_counts(pages: DataFrame) -> DataFrame:
    """domain, page, http_status, n_products (null: no key), n_new: products not seen on an earlier page."""
    new = first_seen_products(explode_products(pages).select("domain", "page", "pos", F.col("p.id").alias("product_id"))).groupBy("domain", "page").agg(F.count("*").alias("n_new"))
    rows = parse_pages(pages).select("domain", "page", "http_status", F.when(F.col("products").isNotNull(), F.size("products")).alias("n_products"))
    return rows.join(new, ["domain", "page"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))
