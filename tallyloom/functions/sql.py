"""The column helpers as SQL functions of a session, made from the helpers themselves.

A helper is applied to columns named as the function's parameters, and the expression that Spark resolves it to becomes the
body of a temporary SQL function; so there is one definition, and the optimiser sees through the call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import text as T
from . import urls as U

#: Function, its parameters, and the helper that it is. Helpers with patterns of their own are made by `register` calls.
FUNCTIONS: dict[str, tuple[str, Callable[..., Column]]] = {
    "clean_optional": ("x STRING", U.clean_optional),
    "normalize_url": ("url STRING", U.normalize_url),
    "url_host": ("url STRING", U.host),
    "domain_key": ("url STRING", U.domain_key),
    "canonical_website": ("url STRING", U.canonical_website),
    "image_key": ("url STRING", U.image_key),
    "join_url": ("base STRING, link STRING", U.join_url),
    "product_url": ("explicit STRING, handle STRING, base STRING", U.product_url),
    "file_name": ("url STRING", U.file_name),
    "loose_bool": ("x STRING", T.loose_bool),
    "loose_int": ("x STRING", T.loose_int),
    "price_cents": ("x STRING", T.price_cents),
    "gender_token": ("x STRING", T.gender_token),
    "social_handle": ("html STRING", T.social_handle),
    "squash": ("text STRING", T.squash),
    "visible_text": ("html STRING", T.visible_text),
    "title_of": ("html STRING", T.title_of),
    "legal_page": ("text STRING", T.legal_page),
    "short_message": ("text STRING", T.short_message),
    "duration_text": ("seconds BIGINT", T.duration_text),
    "zip_code": ("text STRING", T.zip_code),
    "house_number": ("text STRING", T.house_number),
}


def register_one(spark: SparkSession, name: str, parameters: str, helper: Callable[..., Column]) -> None:
    """A temporary SQL function of the name. Helpers that use lambda functions have no SQL text and are refused by Spark."""
    empty = spark.createDataFrame([], parameters)
    made = empty.select(helper(*map(F.col, empty.columns)).alias("r"))
    body = made._jdf.queryExecution().analyzed().expressions().head().sql()
    body = body[: body.rindex(" AS ")]
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {made.schema['r'].dataType.simpleString()} RETURN {body}")


def register(spark: SparkSession, functions: dict[str, tuple[str, Callable[..., Column]]] | None = None) -> list[str]:
    """Make all FUNCTIONS (or those given) callable in this session's SQL; their names."""
    functions = FUNCTIONS if functions is None else functions
    for name, (parameters, helper) in functions.items():
        register_one(spark, name, parameters, helper)
    return list(functions)
