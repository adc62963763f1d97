"""Tumbling event-time windows and the report on late readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvane.functions.numbers import infinite_to_zero
from kelvane.functions.times import floor_ms, to_ms, width_ms

# Widths in a chunk of the running minimum.
CHUNK = 10_000


def tumble(readings: DataFrame, width: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """Max and mean of temperature and humidity per room and window [start, end).

    With ``watermark`` set and a stream in append mode each window is emitted
    once, when the largest event time is ``watermark`` past its end.
    """
    source = readings.withWatermark("time", watermark) if watermark else readings
    stats = source.groupBy(F.window("time", width).alias("w"), "room").agg(
        F.max("temp_c").alias("max_temp"),
        F.avg("temp_c").alias("avg_temp"),
        F.max("humidity").alias("max_humidity"),
        F.avg("humidity").alias("avg_humidity"),
    )
    return stats.select(
        "room",
        F.unix_millis("w.start").alias("bucket_ms"),
        infinite_to_zero(F.col("max_temp")).alias("max_temp"),
        "avg_temp",
        infinite_to_zero(F.col("max_humidity")).alias("max_humidity"),
        "avg_humidity",
    )


def sessions(
    readings: DataFrame, gap: str = "30 minutes", gaps: dict[str, str] | None = None, watermark: str | None = None,
) -> DataFrame:
    """Readings of a room with no pause longer than its gap between them.

    ``gaps`` names rooms with another gap than ``gap``. Columns: room,
    ``start_ms``, ``end_ms`` (last reading plus gap), ``n``, ``max_temp``, ``avg_temp``.

    A stream keeps open sessions as state; a late reading may join two of them,
    and a session is emitted once the watermark passes its end. A table is first
    reduced to a row per room and slot of the gap's width, whose readings are
    always of one session, so that a room comes to one row per slot at most.
    """
    room_gap = F.lit(width_ms(gap)).cast("bigint")
    for room, width in (gaps or {}).items():
        room_gap = F.when(F.col("room") == room, F.lit(width_ms(width))).otherwise(room_gap)
    if readings.isStreaming:
        text = F.concat(room_gap.cast("string"), F.lit(" milliseconds"))
        source = readings.withWatermark("time", watermark) if watermark else readings
        found = source.groupBy(F.session_window("time", text).alias("w"), "room").agg(
            F.count("*").alias("n"), F.max("temp_c").alias("max_temp"), F.avg("temp_c").alias("avg_temp"))
        return found.select("room", F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"),
                            "n", infinite_to_zero(F.col("max_temp")).alias("max_temp"), "avg_temp")
    ms = to_ms(F.col("time"))
    slots = readings.filter(F.col("time").isNotNull()).withColumn("_gap", room_gap).groupBy(
        "room", "_gap", F.floor(ms / F.col("_gap")).alias("_slot")).agg(
        F.min(ms).alias("_first"), F.max(ms).alias("_last"), F.count("*").alias("n"),
        F.count("temp_c").alias("_n"), F.sum("temp_c").alias("_sum"), F.max("temp_c").alias("max_temp"))
    in_room = Window.partitionBy("room").orderBy("_slot")
    pause = F.col("_first") - F.lag("_last").over(in_room) > F.col("_gap")
    numbered = slots.withColumn("_new", F.coalesce(pause, F.lit(True)).cast("int")).withColumn(
        "_session", F.sum("_new").over(in_room))
    return numbered.groupBy("room", "_session").agg(
        F.min("_first").alias("start_ms"), F.max(F.col("_last") + F.col("_gap")).alias("end_ms"), F.sum("n").alias("n"),
        infinite_to_zero(F.max("max_temp")).alias("max_temp"),
        F.when(F.sum("_n") > 0, F.sum("_sum") / F.sum("_n")).alias("avg_temp")).drop("_session")


def as_table_rows(window_results: DataFrame) -> DataFrame:
    """Window results in the column form of the stored table."""
    return window_results.withColumn("bucket", F.timestamp_millis("bucket_ms")).select(
        "bucket", "room", "max_temp", "avg_temp", "max_humidity", "avg_humidity",
        F.to_date("bucket").alias("event_date"))


def from_table_rows(stored: DataFrame) -> DataFrame:
    """Stored rows back to window results."""
    return stored.select(
        "room", to_ms(F.col("bucket")).alias("bucket_ms"),
        "max_temp", "avg_temp", "max_humidity", "avg_humidity")


def with_lateness(
    readings: DataFrame,
    arrival: str = "arrival",
    width: str = "5 minutes",
    delay: str = "10 seconds",
) -> DataFrame:
    """Add ``late``: the reading's window had closed when the reading arrived.

    A window closes with the first arrival whose event time is ``delay`` past
    its end. That arrival is found per window from one aggregate over buckets
    of delayed event time and a running minimum over those buckets, so neither
    readings nor arrivals are ever sorted. ``arrival`` is any orderable column;
    equal values count as simultaneous. Batch input only.
    """
    step, wait = width_ms(width), width_ms(delay)
    ms = to_ms(F.col("time"))
    bucketed = readings.withColumn("_bucket", floor_ms(ms, step)).withColumn(
        "_closes", floor_ms(ms - wait, step))
    # One row per distinct bucket: the time span divided by the width.
    firsts = bucketed.groupBy("_closes").agg(F.min(arrival).alias("_first"))
    # A reading's window ends one step past its bucket, and its bucket lies at
    # most ``reach`` steps past its delayed one: every end that can be asked for.
    reach = -(-wait // step)
    ends = firsts.select(F.explode(F.sequence(
        F.col("_closes") + step, F.col("_closes") + (reach + 1) * step,
        F.lit(step).cast("bigint"))).alias("_at")).distinct()
    marks = firsts.select(F.col("_closes").alias("_at"), "_first", F.lit(False).alias("_is_end")
                          ).unionByName(ends.select(
        "_at", F.lit(None).cast(firsts.schema["_first"].dataType).alias("_first"),
        F.lit(True).alias("_is_end")))
    # A running minimum from the last bucket back, per chunk of time, and from
    # one summary row per chunk what the later chunks add.
    marks = marks.withColumn("_chunk", floor_ms(F.col("_at"), CHUNK * step))
    onward = Window.partitionBy("_chunk").orderBy(F.desc("_at"), "_is_end").rowsBetween(
        Window.unboundedPreceding, 0)
    later = Window.orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    chunks = marks.groupBy("_chunk").agg(F.min("_first").alias("_least")).select(
        "_chunk", F.min("_least").over(later).alias("_later"))
    closing = (
        marks.withColumn("_closed_by", F.min("_first").over(onward))
        .filter("_is_end").join(chunks, "_chunk")
        .select((F.col("_at") - step).alias("_bucket"),
                F.least("_closed_by", "_later").alias("_closed_by"))
    )
    return (
        bucketed.join(closing, "_bucket", "left")
        .withColumn("late", F.coalesce(F.col(arrival) > F.col("_closed_by"), F.lit(False)))
        .drop("_bucket", "_closes", "_closed_by")
    )
