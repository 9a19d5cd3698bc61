"""JSON text as VARIANT, with the distinctions a dynamically typed reader makes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _seal(text: Column) -> Column:
    """A number that the text itself cannot hold, since it is the text's hash."""
    return F.xxhash64(text)


def parse_guarded(text: Column) -> Column:
    """The JSON value of the text as the first of two array elements.

    The parser stops after the first value, so the text is read inside an array that its hash
    closes: anything left over behind the value moves or hides the hash, see ``is_complete``.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), _seal(text), F.lit("]")))


def is_complete(guarded: Column, text: Column) -> Column:
    """Whether the text was exactly one JSON value."""
    sealed = get(guarded, "$[1]", "bigint") == _seal(text)
    return F.coalesce(sealed & get(guarded, "$[2]").isNull(), F.lit(False))


def get(value: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, path, kind)


def is_kind(value: Column, kind: str) -> Column:
    """Whether the value is an OBJECT, ARRAY, STRING, BOOLEAN or VOID (JSON null)."""
    return F.coalesce(F.schema_of_variant(value).startswith(kind), F.lit(False))


def truthy(value: Column) -> Column:
    """Whether Python would treat the JSON value as true; an absent value is false."""
    text = get(value, "$", "string")
    number = text.try_cast("double")
    empty = text.isNull() | text.isin("false", "[]", "{}") | F.coalesce(number == 0, F.lit(False))
    return F.when(is_kind(value, "STRING"), text != "").otherwise(~empty)
