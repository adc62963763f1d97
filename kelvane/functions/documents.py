"""JSON text as VARIANT, accepting exactly one standard JSON value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid_text(value: Column) -> Column:
    """Bytes or text as a string, null where it is not UTF-8."""
    return F.try_validate_utf8(value.cast("string"))


def _mark(text: Column) -> Column:
    return F.hex(F.xxhash64(text))


def framed(text: Column) -> Column:
    """The text parsed inside brackets, followed by its own hash.

    The parser stops behind the first value; so anything behind it breaks the
    array or takes the place of the hash.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), _mark(text), F.lit('"]')))


def whole_document(text: Column, frame: Column | None = None) -> Column:
    """The document, or null where ``text`` is not one JSON value and nothing else.

    ``frame`` is ``framed(text)`` where it is at hand as a column: both of its
    elements are looked at, and it should not be parsed for each.
    """
    frame = framed(text) if frame is None else frame
    return F.when(
        F.try_variant_get(frame, "$[1]", "string") == _mark(text),
        F.try_variant_get(frame, "$[0]", "variant"))


def looks_like_object(text: Column) -> Column:
    return F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{"))


def json_type(document: Column, field: str) -> Column:
    """Type of a top-level field as text, null where absent."""
    return F.schema_of_variant(F.try_variant_get(document, f"$.{field}", "variant"))
