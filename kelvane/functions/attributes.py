"""Look-ups in key/value attribute arrays.

The arrays stay arrays: a key may occur twice and position decides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_values(attributes: Column, key: str) -> Column:
    """Text values of ``key`` in order; a value of another type reads as ''."""
    hits = F.filter(attributes, lambda a: a["key"] == key)
    return F.transform(hits, lambda a: F.coalesce(a["value"]["string_value"], F.lit("")))


def last_text(attributes: Column, key: str) -> Column:
    """Text of the last ``key``, or ''."""
    return F.coalesce(F.try_element_at(text_values(attributes, key), F.lit(-1)), F.lit(""))


def last_int(attributes: Column, key: str) -> Column:
    """Integer of the last ``key``, or null."""
    hits = F.filter(attributes, lambda a: a["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]["int_value"]


def first_text(attributes: Column, key: str) -> Column:
    """First non-empty text under ``key``, or ''."""
    hits = F.filter(
        attributes, lambda a: (a["key"] == key) & (a["value"]["string_value"] != ""))
    return F.coalesce(F.get(hits, F.lit(0))["value"]["string_value"], F.lit(""))


def first_filled(values: Column) -> Column:
    """First non-empty text of an array, or ''."""
    return F.coalesce(F.try_element_at(F.filter(values, lambda v: v != ""), F.lit(1)), F.lit(""))


def attribute(key: str, text: Column | None = None, number: Column | None = None) -> Column:
    """One key/value entry holding a text or an integer."""
    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            (F.lit(None).cast("string") if text is None else text).alias("string_value"),
            (F.lit(None).cast("bigint") if number is None else number).alias("int_value"),
            F.lit(None).cast("double").alias("double_value"),
            F.lit(None).cast("boolean").alias("bool_value"),
        ).alias("value"),
    )
