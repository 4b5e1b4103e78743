"""Presence-aware access to VARIANT objects (P9 on sidecar documents).

A key that exists with a null value yields a variant null, a missing key SQL
NULL; plain JSON columns cannot tell them apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def member(obj, key: str) -> Column:
    """Value of ``key`` as a VARIANT; SQL NULL only if the key is missing or
    ``obj`` is no object."""
    return F.try_variant_get(_c(obj), f"$.{key}", "variant")


def first_present(obj, keys: list[str]) -> Column:
    """The value of the first key that exists, a null value included."""
    return F.coalesce(*[member(obj, k) for k in keys])


def kind(v) -> Column:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``BOOLEAN``, ``VOID`` (a null value),
    ``BIGINT``, ``DECIMAL`` or ``DOUBLE``; NULL for SQL NULL."""
    return F.regexp_extract(F.schema_of_variant(_c(v)), r"^[A-Z]+", 0)


def as_string(v) -> Column:
    """The text of a JSON string; NULL for every other kind of value."""
    return F.when(kind(v) == "STRING", F.try_variant_get(_c(v), "$", "string"))


def as_number_text(v) -> Column:
    """Text of a scalar that may stand for a number: numbers, strings, and true
    and false as 1 and 0; NULL for objects, arrays and null."""
    t = F.try_variant_get(_c(v), "$", "string")
    return (F.when(kind(v) == "BOOLEAN", F.when(t == "true", "1").otherwise("0"))
            .when(kind(v).isin("OBJECT", "ARRAY", "VOID"), F.lit(None)).otherwise(t))


def as_integer(v) -> Column:
    """Whole number of a scalar: numbers are cut toward zero, strings must be
    written as whole numbers; else NULL."""
    t = F.trim(as_number_text(v))
    whole = F.when(F.regexp_like(t, F.lit(r"^[+-]?\d+$")), t.try_cast("long"))
    return F.when(kind(v) == "STRING", whole).otherwise(F.coalesce(whole, t.try_cast("double").try_cast("long")))


def elements(v) -> Column:
    """``array<variant>`` of a JSON array; NULL for every other value."""
    return F.when(kind(v) == "ARRAY", F.try_variant_get(_c(v), "$", "array<variant>"))


def truthy(v) -> Column:
    """``v`` where it is neither missing, null, false, 0, "" nor an empty array or object."""
    text = F.try_variant_get(_c(v), "$", "string")
    empty = (kind(v).isNull() | (kind(v) == "VOID") | (text == "") & (kind(v) == "STRING") | (kind(v) == "BOOLEAN") & (text == "false")
             | kind(v).isin("BIGINT", "DECIMAL", "DOUBLE") & (text.try_cast("double") == 0)
             | (F.to_json(_c(v)) == "[]") | (F.to_json(_c(v)) == "{}"))
    return F.when(~F.coalesce(empty, F.lit(False)), _c(v))
