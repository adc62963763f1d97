"""Data-quality checks. Each returns violations, or a summary where it says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.functions.documents import json_type, valid_text, whole_document
from kelvane.functions.once import computed_once
from kelvane.functions.times import floor_ms, to_ms, width_ms
from kelvane.operators.payload import FIELDS, SCHEMA_VERSION

# Plausible ranges of a reading and of an aggregate.
READING_RANGES = {"temp_c": (15.0, 30.0), "humidity": (0.0, 100.0)}
AGGREGATE_RANGE = (18.0, 26.0)


def field_mismatches(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payloads whose top-level fields are not exactly those of version 1."""
    # Anything but one JSON object has no keys, so it lacks every field.
    text = valid_text(F.col(value))
    keys = F.coalesce(
        F.when(whole_document(text).isNotNull(), F.json_object_keys(text)),
        F.array().cast("array<string>"))
    expected = F.array(*[F.lit(f) for f in FIELDS])
    found = computed_once(messages.withColumn("_keys", keys), list(keep),
        missing=F.array_sort(F.array_except(expected, "_keys")),
        unexpected=F.array_sort(F.array_except("_keys", expected)))
    return found.filter((F.size("missing") > 0) | (F.size("unexpected") > 0))


def type_mismatches(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payloads whose version is not the text "1" or whose time is not an integer."""
    doc = F.col("_doc")

    def kind(field: str) -> Column:
        return F.coalesce(F.substring_index(json_type(doc, field), "(", 1), F.lit("ABSENT"))

    found = computed_once(
        messages.withColumn("_doc", whole_document(valid_text(F.col(value)))), list(keep),
        readable=doc.isNotNull(),
        version_type=kind("schema_version"),
        version=F.try_variant_get(doc, "$.schema_version", "string"),
        time_type=kind("timestamp_ms"))
    return found.filter(
        F.col("readable") & (
            (F.col("version_type") != "STRING") | (F.col("version") != SCHEMA_VERSION)
            | (F.col("time_type") != "BIGINT"))
    ).drop("readable")


def _outside(column: str, low: float, high: float) -> Column:
    return ~F.col(column).between(low, high)


def out_of_range(readings: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Per sensor with any, the number of readings outside each range."""
    ranges = ranges or READING_RANGES
    bad = [_outside(c, *r) for c, r in ranges.items()]
    either = bad[0]
    for b in bad[1:]:
        either = either | b
    return (
        readings.filter(either).groupBy("sensor_id")
        .agg(*[F.count_if(b).alias(f"{c}_bad") for c, b in zip(ranges, bad)])
    )


def sensors_in_many_rooms(readings: DataFrame) -> DataFrame:
    return (
        readings.groupBy("sensor_id").agg(F.count_distinct("room").alias("rooms"))
        .filter("rooms > 1")
    )


def repeated_ids(registry: DataFrame) -> DataFrame:
    """Sensor ids a registry lists more than once."""
    return registry.groupBy("sensor_id").agg(F.count("*").alias("n")).filter("n > 1")


def far_from_arrival(readings: DataFrame, tolerance_ms: int = 5000,
                     arrival_time: str = "arrival_time") -> DataFrame:
    """Readings whose event time is further from arrival than the tolerance."""
    gap = F.abs(to_ms(F.col(arrival_time)) - to_ms(F.col("time")))
    return readings.withColumn("gap_ms", gap).filter(F.col("gap_ms") > tolerance_ms)


def cadence(readings: DataFrame, chunk: str = "1 hour") -> DataFrame:
    """Summary per sensor of the gaps between its readings, in milliseconds.

    A busy sensor's history is split by time. Copies of a time collapse before
    the shuffle, so a chunk holds at most one row per millisecond; the gap over
    a chunk border comes from one row per chunk.
    """
    times = readings.select("sensor_id", to_ms(F.col("time")).alias("ms")).groupBy(
        "sensor_id", "ms").agg(F.count("*").alias("copies"))
    chunked = times.withColumn("_chunk", floor_ms(F.col("ms"), width_ms(chunk)))
    inside = Window.partitionBy("sensor_id", "_chunk").orderBy("ms")
    per_chunk = (
        chunked.withColumn("gap", F.col("ms") - F.lag("ms").over(inside))
        .groupBy("sensor_id", "_chunk")
        .agg(
            F.sum("copies").alias("n"),
            F.min("ms").alias("first"), F.max("ms").alias("last"),
            F.min(F.when(F.col("copies") > 1, F.lit(0)).otherwise(F.col("gap"))).alias("low"),
            F.max("gap").alias("high"),
            F.max(F.when(F.col("copies") > 1, F.lit(0))).alias("zero"))
    )
    border = F.col("first") - F.lag("last").over(Window.partitionBy("sensor_id").orderBy("_chunk"))
    return (
        per_chunk.withColumn("border", border)
        .groupBy("sensor_id")
        .agg(
            F.sum("n").alias("readings"),
            F.min(F.least("low", "border")).alias("min_gap_ms"),
            F.max(F.greatest("high", "border", "zero")).alias("max_gap_ms"),
            # Gaps in a row add up to last minus first.
            ((F.max("last") - F.min("first")) / (F.sum("n") - 1)).alias("mean_gap_ms"))
        .filter("readings > 1")
    )


def misaligned_buckets(window_results: DataFrame, width: str = "5 minutes") -> DataFrame:
    return window_results.filter(F.pmod("bucket_ms", F.lit(width_ms(width))) != 0)


def absent(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys that no row carries."""
    return expected.select(*keys).join(observed.select(*keys).distinct(), keys, "left_anti")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def implausible_windows(window_results: DataFrame, low: float = AGGREGATE_RANGE[0],
                        high: float = AGGREGATE_RANGE[1]) -> DataFrame:
    return window_results.filter(_outside("max_temp", low, high) | _outside("avg_temp", low, high))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """One row: number of alerts, and of alerts with an unset field."""
    unset = F.lit(False)
    for column in alerts.columns:
        unset = unset | F.col(column).isNull()
    return alerts.agg(F.count("*").alias("alerts"), F.count_if(unset).alias("incomplete"))


def stuck_sensors(readings: DataFrame, width: str = "1 hour", at_least: int = 3) -> DataFrame:
    """Sensors that repeat one temperature through a window of several readings.

    All values equal means min equals max: no distinct count is needed.
    """
    return (
        readings.groupBy(F.window("time", width).alias("w"), "sensor_id")
        .agg(F.count("*").alias("n"), F.min("temp_c").alias("low"), F.max("temp_c").alias("high"))
        .filter((F.col("n") >= at_least) & (F.col("low") == F.col("high")))
        .select("sensor_id", F.unix_millis("w.start").alias("bucket_ms"), "n",
                F.col("low").alias("temp_c"))
    )


def rows_per_day(readings: DataFrame) -> DataFrame:
    """Summary: number of readings per UTC day."""
    return readings.groupBy(F.to_date("time").alias("day")).agg(F.count("*").alias("n"))
