"""Strict decoding of versioned JSON readings.

``from_json`` converts types, takes single quotes and ignores text behind the
closing brace, so the payload is read as VARIANT, which keeps the JSON types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kelvane.functions.documents import framed, looks_like_object, valid_text, whole_document
from kelvane.functions.once import computed_once

# Fixed values of payload version 1.
SCHEMA_VERSION = "1"
TEXT_FIELDS = ["schema_version", "sensor_id", "room"]
NUMBER_FIELDS = ["temp_c", "humidity", "pressure"]
TIME_FIELD = "timestamp_ms"
FIELDS = TEXT_FIELDS + NUMBER_FIELDS + [TIME_FIELD]

NANOS_PER_MS = 1_000_000
LONG_MAX = 2**63 - 1
UNSIGNED_MAX = 2**64 - 1


def nanos(timestamp_ms: Column) -> Column:
    """Milliseconds to nanoseconds, held at the largest signed long."""
    return F.coalesce(F.try_multiply(timestamp_ms, F.lit(NANOS_PER_MS)), F.lit(LONG_MAX))


def parse_payloads(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``reading`` (a struct of the seven fields) and ``reject_reason``.

    Exactly one of the two is null. ``value`` is a binary or string column.
    """
    own = messages.columns
    # Each step is worked out once: the text, its one parse, one look-up a field.
    parsed = computed_once(messages, own, _text=valid_text(F.col(value)))
    parsed = computed_once(parsed, [*own, "_text"], _framed=framed(F.col("_text")))
    parsed = computed_once(parsed, [*own, "_text"], _doc=whole_document(F.col("_text"), F.col("_framed")))
    doc, fields = F.col("_doc"), {f: f"_{f}" for f in FIELDS}
    found = computed_once(parsed, [*own, "_text", "_doc"], **{
        name: F.try_variant_get(doc, f"$.{f}", "variant") for f, name in fields.items()})
    kinds = {**dict.fromkeys(TEXT_FIELDS, "string"), **dict.fromkeys(NUMBER_FIELDS, "double"),
             TIME_FIELD: "bigint"}
    typed = found.withColumn("_raw", F.struct(
        *[F.schema_of_variant(name).alias(f"{f}_type") for f, name in fields.items()],
        *[F.try_variant_get(F.col(name), "$", kinds[f]).alias(f) for f, name in fields.items()]))
    raw = F.col("_raw")
    reason = F.when(F.col(value).isNull() | (F.octet_length(value) == 0), "empty")
    reason = reason.when(F.col("_text").isNull(), "invalid_utf8")
    reason = reason.when(doc.isNull(), "malformed_json")
    reason = reason.when(~looks_like_object(F.col("_text")), "not_an_object")
    for field in FIELDS:
        kind = raw[f"{field}_type"]
        reason = reason.when(kind.isNull(), f"missing:{field}")
        if field in TEXT_FIELDS:
            bad = kind != "STRING"
        elif field in NUMBER_FIELDS:
            number = kind.isin("BIGINT", "DOUBLE") | F.startswith(kind, F.lit("DECIMAL"))
            # JSON has no infinity: one can only come from a literal out of range.
            bad = ~number | raw[field].isin(float("inf"), float("-inf"))
        else:
            bad = (kind != "BIGINT") | (raw[field] < 0)
        reason = reason.when(bad, f"type:{field}")
    reason = reason.when(raw["schema_version"] != SCHEMA_VERSION, "unsupported_version")
    reason = reason.when(raw[TIME_FIELD] > UNSIGNED_MAX // NANOS_PER_MS, "time_overflow")
    decided = typed.withColumn("_reason", reason)
    return computed_once(
        decided, messages.columns,
        reading=F.when(F.col("_reason").isNull(), F.struct(*[raw[f].alias(f) for f in FIELDS])),
        reject_reason=F.col("_reason"))


def accepted(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Good rows of ``parse_payloads`` with event time and nanoseconds."""
    return (
        parsed.filter(F.col("reject_reason").isNull())
        .select(*keep, "reading.*")
        .withColumn("time", F.timestamp_millis(TIME_FIELD))
        .withColumn("ts_nanos", nanos(F.col(TIME_FIELD)))
    )


def rejected(parsed: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bad rows with their reason and the untouched value."""
    return (
        parsed.filter(F.col("reject_reason").isNotNull()).select(*keep, value, "reject_reason")
    )


def count_outcomes(parsed: DataFrame, seen: Observation | str = "payloads") -> DataFrame:
    """Attach counters of accepted and rejected payloads.

    They arrive in ``seen`` or, for a name, with the metrics of the query.
    """
    bad = F.col("reject_reason").isNotNull()
    return parsed.observe(
        seen,
        F.count_if(~bad).alias("accepted"),
        F.count_if(bad).alias("rejected"),
    )


def encode_payloads(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Readings back to version 1 JSON in a ``value`` column."""
    return readings.select(*keep, F.to_json(F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        "sensor_id", "room", "temp_c", "humidity", "pressure",
        F.unix_millis("time").alias(TIME_FIELD),
    )).alias("value"))
