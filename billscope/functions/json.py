"""Fields from JSON kept in a text column: one parse per document, all keys read from it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's variant functions name a text so in a schema.
TEXT = "STRING"


def parsed(document: Column) -> Column:
    """The document as a variant; NULL when it is no JSON."""
    return F.try_parse_json(document)


def _path(key: str) -> str:
    mark = '"' if "'" in key else "'"
    if mark in key:
        raise ValueError(f"a key with both kinds of quotes has no path: {key}")
    return f"$[{mark}{key}{mark}]"


def text_field(variant: Column, key: str) -> Column:
    """The text under ``key``; the empty text when the key is missing or its value is not a text."""
    value = F.try_variant_get(variant, _path(key), "variant")
    return F.when(F.schema_of_variant(value) == TEXT, F.try_variant_get(variant, _path(key), "string")).otherwise("")


def any_field(variant: Column, key: str) -> Column:
    """The value under ``key`` as text whatever its type; the empty text when missing."""
    return F.coalesce(F.try_variant_get(variant, _path(key), "string"), F.lit(""))


def _in_broken(document: Column, key: str) -> Column:
    """The text behind ``"key":`` in a document that is no JSON; the empty text when there is none."""
    return F.coalesce(F.regexp_extract(document, rf'"{re.escape(key)}"\s*:\s*"((?:[^"\\]|\\.)*)"', 1), F.lit(""))


def json_string(document: Column, key: str) -> Column:
    """``text_field`` of a document of which one key is wanted; of a broken document what stands behind the key."""
    variant = parsed(document)
    return F.when(variant.isNull(), _in_broken(document, key)).otherwise(text_field(variant, key))


def json_value(document: Column, key: str) -> Column:
    """``any_field`` of a document of which one key is wanted."""
    return any_field(parsed(document), key)


def with_texts(df: DataFrame, document: str, keys: dict[str, str]) -> DataFrame:
    """``df`` with a column for each of {name: key}, the key's text in the JSON of ``document``, which is parsed once.

    Only a document that does not parse is searched per key, as ``json_string`` does.
    """
    whole = df.withColumn("_json", parsed(F.col(document)))
    broken = F.col("_json").isNull()
    texts = {name: F.when(broken, _in_broken(F.col(document), key)).otherwise(text_field(F.col("_json"), key)) for name, key in keys.items()}
    return whole.withColumns(texts).drop("_json")
