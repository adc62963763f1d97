"""Readings from an ``events`` table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def scan_events(
    spark: SparkSession, folder: str, start: datetime | None = None, end: datetime | None = None,
) -> DataFrame:
    """Stored events, from ``start`` up to and with the millisecond of ``end``.

    Bounds apply to the stored time, so the scan skips what lies outside.
    """
    events = spark.read.schema(EVENT_SCHEMA).parquet(f"{folder}/events.parquet")

    def stored(at: datetime) -> Column:
        return F.lit(at.astimezone(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")

    if start is not None:
        events = events.filter(F.col("ts") >= stored(start))
    if end is not None:
        events = events.filter(F.col("ts") < stored(end + timedelta(milliseconds=1)))
    return events


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", "events.parquet").parquet(folder)
    )


def as_readings(events: DataFrame) -> DataFrame:
    """One reading per event, in the column form of ``readings_raw``.

    ``arrival`` is the order of arrival. Times are cut to milliseconds.
    """
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.timestamp_millis(millis).alias("time"),
        F.concat(F.lit("sensor-"), F.col("user_id").cast("string")).alias("sensor_id"),
        F.col("event_type").alias("room"),
        F.col("value").alias("temp_c"),
        F.get_json_object("props", "$.k").cast("double").alias("humidity"),
        (F.lit(1000.0) + F.pmod("event_id", F.lit(30))).alias("pressure"),
        F.col("event_id").alias("arrival"),
    )
