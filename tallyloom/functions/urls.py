"""URLs, domains and object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\r\n\f"


def clean_optional(x: Column) -> Column:
    """Trimmed; null where nothing is left."""
    return F.nullif(F.btrim(x, F.lit(SPACES)), F.lit(""))


def normalize_url(x: Column) -> Column:
    """Scheme and host of a trimmed url, https where it names none; null without a host or with white space in it."""
    trimmed = F.btrim(x, F.lit(SPACES))
    full = F.when(trimmed.rlike("(?i)^https?://"), trimmed).otherwise(F.concat(F.lit("https://"), trimmed))
    host = F.regexp_extract(full, "^[^:]+://([^/?#]*)", 1)
    scheme = F.lower(F.regexp_extract(full, "^([^:]+)://", 1))
    return F.when((host != "") & ~host.rlike(r"\s"), F.concat(scheme, F.lit("://"), host))


def host(x: Column) -> Column:
    return F.lower(F.regexp_extract(x, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def domain_key(x: Column, bare: bool = True) -> Column:
    """Lower-case host without one leading `www.`; with bare, a url without a scheme counts up to its first slash."""
    trimmed = F.lower(F.btrim(x, F.lit(SPACES)))
    found = host(trimmed)
    if bare:
        found = F.when(found == "", F.regexp_extract(trimmed, "^[^/]*", 0)).otherwise(found)
    return F.regexp_replace(found, r"^www\.", "")


def canonical_website(x: Column) -> Column:
    key = domain_key(x)
    return F.when(key != "", F.concat(F.lit("https://"), key)).otherwise(F.btrim(x, F.lit(SPACES)))


def image_key(x: Column) -> Column:
    """Without the query string."""
    return F.substring_index(F.btrim(x, F.lit(SPACES)), "?", 1)


def image_keys(images: Column) -> Column:
    """Keys of the images that are not blank, in order."""
    return F.transform(F.filter(F.coalesce(images, F.array().cast("array<string>")), lambda u: clean_optional(u).isNotNull()), image_key)


def join_url(base: Column, link: Column) -> Column:
    """An absolute link as it is; protocol-relative, root-relative and relative ones against a base."""
    origin = F.regexp_extract(base, "^[^:]+://[^/?#]*", 0)
    return (
        F.when(link.rlike("(?i)^[a-z][a-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]+:)", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(F.rtrim(origin, F.lit("/")), F.lit("/"), link))
    )


def product_url(explicit: Column, handle: Column, base: Column) -> Column:
    """An explicit product url against the base, else the base's page of the handle."""
    named = clean_optional(explicit)
    page = F.concat(F.rtrim(base, F.lit("/")), F.lit("/products/"), F.btrim(handle, F.lit("/")))
    return F.when(named.isNotNull(), join_url(base, named)).when(clean_optional(handle).isNotNull(), page)


def file_name(url: Column, default: str = "image.jpg") -> Column:
    path = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|[?#].*$", "")
    return F.coalesce(F.nullif(F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1), F.lit("")), F.lit(default))


def object_path(url: Column, prefix: str) -> Column:
    """What follows a public prefix; null elsewhere."""
    return F.when(url.startswith(prefix), F.substring(url, len(prefix) + 1, 1 << 30))


def hash_shard(website: Column, shards: int) -> Column:
    """sha256 of the website as one large integer, modulo the number of shards, digit by digit."""
    digits = F.split(F.sha2(website, 256), "")
    return F.aggregate(digits, F.lit(0), lambda acc, d: F.pmod(acc * 16 + F.conv(d, 16, 10).cast("int"), F.lit(shards)))
