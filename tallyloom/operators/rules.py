"""Which products stay: keyword, image and quality rules. Vocabularies are parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words, codes and limits that results depend on.
KIDS_PARTS = ("kid", "child", "boy", "girl", "toddler", "baby", "babies", "infant", "newborn", "youth", "junior")
KIDS_PROTECTED = "babydoll"
BEAUTY_TYPES = r"cosmetics?|beauty|make[\s-]*up|nails?|nail[\s-]*polish|fragrances?|perfumes?|skin[\s-]*care|grooming"
COLLISION_WORDS = r"vintage|beaut(?:y|ies)|glass(?:es)?"
HARD_DELETE = r"nipple[\s-]*covers?|pasties|breast[\s-]*petals?|(?:boob|body|breast|fashion)[\s-]*tape"
DROP_CODES = ("not_a_product_photo", "unsupported_file_type", "invalid_image", "resolution_too_low", "image_too_blurry")
MAX_BYTES = 50 * 1024 * 1024
MIN_WIDTH, MIN_HEIGHT, MAX_SIDE = 600, 800, 12000
MIN_ASPECT, MAX_ASPECT = 0.5, 2.0
MIN_BLUR, MIN_TENENGRAD, MIN_PATCH = 20.0, 1.8, 35.0
EDGE_STEPS = ((0.08, 0.55), (0.14, 0.75))
HIGH_EDGE, HIGH_EDGE_FACTOR = 0.20, 0.60
MIN_BRIGHTNESS, MAX_BRIGHTNESS, MIN_CONTRAST, MIN_PROB = 55.0, 240.0, 18.0, 0.50
MIN_IMAGES = 2
MAX_CLIPPED = 0.65
# End of fixed values.


def words(pattern: str) -> str:
    """A whole-word pattern, whatever the case and script."""
    return rf"(?iuU)\b(?:{pattern})\b"


def _joined(*columns: Column) -> Column:
    return F.concat_ws(" ", *(F.nullif(c, F.lit("")) for c in columns))


def excluded_category(name: Column, url: Column, handle: Column, kind: Column, categories: str, beauty: str = BEAUTY_TYPES, kids: tuple[str, ...] = KIDS_PARTS) -> Column:
    """The aggressive rule: a beauty type, a kids' part in name, url or handle, or a category word anywhere."""
    young = F.replace(F.lower(_joined(name, url, handle)), F.lit(KIDS_PROTECTED), F.lit(" "))
    part = F.lit(False)
    for k in kids:
        part = part | F.contains(young, F.lit(k))
    by_type = F.coalesce(F.btrim(kind).rlike(words(beauty)), F.lit(False))
    return by_type | part | _joined(name, url, handle, kind).rlike(words(categories))


def clear_nonfashion(name: Column, url: Column, handle: Column, kind: Column, categories: str, guard: str, beauty: str = BEAUTY_TYPES, hard: str = HARD_DELETE, collisions: str = COLLISION_WORDS) -> Column:
    """The safe rule: hard deletes first, then the guard keeps, then beauty types, then category words without the
    ones that collide with garments."""
    named = _joined(name, kind)
    rest = F.regexp_replace(_joined(name, url, handle, kind), words(collisions), " ")
    return (
        F.when(named.rlike(words(hard)), True).when(named.rlike(words(guard)), False)
        .when(F.coalesce(F.btrim(kind).rlike(words(beauty)), F.lit(False)), True).otherwise(rest.rlike(words(categories)))
    )


def image_poor(images: Column, least: int = MIN_IMAGES) -> Column:
    return F.size(F.coalesce(images, F.array().cast("array<string>"))) < least


def attribute_policy(images: Column, hint: Column, sizes: Column, colors: Column, brand: Column) -> tuple[Column, Column, Column]:
    """sizes, colors and brand: cleared without images; else kept where the hint of what was there names them."""
    has = F.size(F.coalesce(images, F.array().cast("array<string>"))) > 0
    text = F.lower(hint)
    any_of = lambda *parts: has & F.coalesce(text.rlike("|".join(parts)), F.lit(False))
    none = F.array().cast("array<string>")
    return (
        F.when(any_of("size", "option", "variant"), sizes).otherwise(none),
        F.when(any_of("color", "colour", "option", "variant"), colors).otherwise(none),
        F.when(any_of("vendor", "brand"), brand),
    )


def _sizes(gate: Column) -> Column:
    return gate.when((F.col("width") < MIN_WIDTH) | (F.col("height") < MIN_HEIGHT), "resolution_too_low")


def blurry() -> Column:
    """All three sharpness scores under their floors; the first floor hangs on how many edges there are."""
    edge = F.col("edge_density")
    factor = F.when(edge >= HIGH_EDGE, HIGH_EDGE_FACTOR)
    for limit, f in EDGE_STEPS:
        factor = factor.when(edge < limit, f)
    return (F.col("blur") < MIN_BLUR * factor.otherwise(1.0)) & (F.col("tenengrad") < MIN_TENENGRAD) & (F.col("patch_p90") < MIN_PATCH)


def quality_gate(clipped: float = MAX_CLIPPED) -> Column:
    """The first code that a row of image metrics earns; null: fine."""
    aspect = F.col("width") / F.col("height")
    gate = F.when(F.col("bytes") == 0, "empty_file").when(F.col("bytes") > MAX_BYTES, "file_too_large").when(F.col("format") == "GIF", "gif_not_supported")
    gate = gate.when(~F.col("format").isin("JPEG", "JPG", "PNG", "HEIC", "HEIF"), "unsupported_file_type")
    gate = _sizes(gate).when((F.col("width") > MAX_SIDE) | (F.col("height") > MAX_SIDE), "resolution_too_high")
    gate = gate.when(~aspect.between(MIN_ASPECT, MAX_ASPECT), "invalid_aspect_ratio").when(blurry(), "image_too_blurry")
    gate = gate.when((F.col("brightness") < MIN_BRIGHTNESS) & (F.col("clipped") >= clipped), "image_too_dark")
    gate = gate.when((F.col("brightness") > MAX_BRIGHTNESS) & (F.col("clipped") >= clipped), "image_too_bright")
    return gate.when(F.col("contrast") < MIN_CONTRAST, "low_contrast").when(F.col("prob") < MIN_PROB, "not_a_product_photo")


def light_gate() -> Column:
    """Size, blur and product probability only."""
    return _sizes(F.when(F.col("bytes") == 0, "empty_file").when(F.col("bytes") > MAX_BYTES, "file_too_large")).when(blurry(), "image_too_blurry").when(F.col("prob") < MIN_PROB, "not_a_product_photo")


def verdict_class(code: Column) -> Column:
    return F.when(code.isNull(), "pass").when(code.isin(*DROP_CODES), "drop").otherwise("transient")
