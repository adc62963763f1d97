"""Monitoring queries over the stored tables.

``rooms=None`` selects every room. Time ranges include both ends.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.functions.numbers import numeric_round
from kelvane.session import shared_root

# Lower bound and label of each temperature band.
TEMPERATURE_BANDS = [(None, "blue"), (18, "green"), (24, "yellow"), (27, "red")]


def select_rooms(rows: DataFrame, rooms: list[str] | None = None) -> DataFrame:
    return rows if rooms is None else rows.filter(F.col("room").isin(rooms))


def select_range(
    rows: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    time: str = "time",
    date: str = "event_date",
) -> DataFrame:
    """Filter by time, and by the date partition that follows from it."""
    for bound, at_least in ((start, True), (end, False)):
        if bound is None:
            continue
        limit = F.lit(bound)
        rows = rows.filter(F.col(time) >= limit if at_least else F.col(time) <= limit)
        if date in rows.columns:
            day = F.to_date(limit)
            rows = rows.filter(F.col(date) >= day if at_least else F.col(date) <= day)
    return rows


def latest_per_room(readings: DataFrame, rooms: list[str] | None = None) -> DataFrame:
    """Newest reading of each room; of several at that time, the first sensor's.

    One scan: the newest per sensor first, with flat buffers, so that only a
    row per sensor and room is compared by time and name.
    """
    per_sensor = select_rooms(readings, rooms).groupBy("room", "sensor_id").agg(
        F.max("time").alias("time"), F.max_by("temp_c", "time").alias("temp_c"))
    # Of equal times the smallest name: unequal times are told apart first.
    newest = per_sensor.groupBy("room").agg(F.min_by(
        F.struct("time", "temp_c"), F.struct(-F.unix_micros("time"), "sensor_id")).alias("r"))
    return newest.select(
        F.col("r.time").alias("time"), "room", numeric_round(F.col("r.temp_c"), 1).alias("temp_c"))


# Days behind which the descent below reads all that is left at once.
DESCENT_DAYS = 4096


def latest_per_room_recent(
    readings: DataFrame, rooms: DataFrame, newest: date | None = None, date_col: str = "event_date",
) -> DataFrame:
    """``latest_per_room`` of the rooms of ``rooms``, read from the newest date back.

    ``readings`` is a stored table with a date partition that follows from the
    time. The first step reads the dates from ``newest`` (by default today) on;
    each further one only the rooms not found yet, over twice as many days; the
    last one all that is left. So a refresh reads one date while every room
    reports, and a room that has been silent for long costs a few steps. Rooms
    without a reading are left out. One row per room is kept between steps.
    """
    shared_root(readings.sparkSession)
    left = rooms.select("room").filter(F.col("room").isNotNull()).distinct()
    day, days = F.col(date_col), 1
    low, high = newest or datetime.now(timezone.utc).date(), None
    found = None
    while True:
        step = readings
        if low is not None:
            step = step.filter(day >= F.lit(low))
        if high is not None:
            step = step.filter(day < F.lit(high))
        here = latest_per_room(step.join(left, "room", "left_semi")).checkpoint()
        found = here if found is None else found.union(here)
        left = left.join(here.select("room"), "room", "left_anti").checkpoint()
        if low is None or left.isEmpty():
            return found
        high, low = low, low - timedelta(days=days) if days <= DESCENT_DAYS else None
        days *= 2


def band(temp: Column, bands: list[tuple] | None = None) -> Column:
    """Label of the highest band whose lower bound is reached; bands ascend."""
    label = None
    for low, name in bands or TEMPERATURE_BANDS:
        label = F.lit(name) if low is None else F.when(temp >= low, name).otherwise(label)
    return label


def room_list(rows: DataFrame) -> DataFrame:
    return rows.select("room").distinct().orderBy("room")


def sensor_list(rows: DataFrame) -> DataFrame:
    return rows.select("sensor_id").distinct().orderBy("sensor_id")


def series_by_minute(
    readings: DataFrame, rooms: list[str] | None = None,
    start: datetime | None = None, end: datetime | None = None, width: str = "1 minute",
) -> DataFrame:
    """Mean temperature per room and minute as (time, metric, value)."""
    chosen = select_range(select_rooms(readings, rooms), start, end)
    return (
        chosen.groupBy(F.window("time", width).alias("w"), "room")
        .agg(F.avg("temp_c").alias("mean"))
        .select(
            F.col("w.start").alias("time"), F.col("room").alias("metric"),
            numeric_round(F.col("mean"), 2).alias("value"))
        .orderBy("time", "metric")
    )


def series_of_windows(
    aggregated: DataFrame, rooms: list[str] | None = None,
    start: datetime | None = None, end: datetime | None = None,
) -> DataFrame:
    """Stored windows as two labelled series per room: mean and max."""
    chosen = select_range(select_rooms(aggregated, rooms), start, end, "bucket")
    both = chosen.select(
        F.col("bucket").alias("time"), "room",
        F.col("avg_temp").alias("avg"), F.col("max_temp").alias("max"),
    ).unpivot(["time", "room"], ["avg", "max"], "kind", "raw")
    return both.select(
        "time", F.concat_ws(" ", "room", "kind").alias("metric"),
        numeric_round(F.col("raw"), 2).alias("value"),
    ).orderBy("time", "metric")


def series_by_hour(
    hourly_temp: DataFrame, rooms: list[str] | None = None,
    start: datetime | None = None, end: datetime | None = None,
) -> DataFrame:
    chosen = select_range(select_rooms(hourly_temp, rooms), start, end, "bucket")
    return chosen.select(
        F.col("bucket").alias("time"), F.col("room").alias("metric"),
        numeric_round(F.col("avg_temp"), 2).alias("value"),
    ).orderBy("time", "metric")


def one_column_per_metric(series: DataFrame, metrics: list[str]) -> DataFrame:
    """Long series to one column per named metric."""
    return series.groupBy("time").pivot("metric", metrics).agg(F.first("value")).orderBy("time")


def alert_log(
    alerts: DataFrame, start: datetime | None = None, end: datetime | None = None,
    rooms: list[str] | None = None, limit: int = 100,
) -> DataFrame:
    """Newest alerts first."""
    chosen = select_range(select_rooms(alerts, rooms), start, end)
    return chosen.orderBy(F.desc("time"), "room", "window_start").limit(limit).select(
        "time", "room", numeric_round(F.col("max_temp"), 1).alias("max_temp"),
        "consecutive_count", "window_start")


def most_recent(rows: DataFrame, time: str, limit: int, ties: tuple[str, ...] = ()) -> DataFrame:
    return rows.orderBy(F.desc(time), *ties).limit(limit)


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n"))
