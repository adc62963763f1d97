from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from kelvane.functions.numbers import numeric_round
from kelvane.operators import dashboard, rollup


def at(minute, second=0):
    return datetime(2024, 1, 1, minute // 60, minute % 60, second, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def readings(spark):
    rows = [(at(0, 10), "s1", "b", 1.005), (at(0, 50), "s2", "b", 2.0), (at(1), "s1", "b", 22.0),
            (at(1), "s2", "b", 99.0), (at(61), "s3", "a", -2.25), (at(5), "s3", "a", 7.0)]
    frame = spark.createDataFrame(rows, "time timestamp, sensor_id string, room string, temp_c double")
    return frame.withColumn("event_date", F.to_date("time"))


def test_latest_per_room(readings):
    rows = dashboard.latest_per_room(readings).orderBy("room").collect()
    assert [(r.room, r.temp_c) for r in rows] == [("a", -2.3), ("b", 22.0)]
    assert dashboard.latest_per_room(readings, ["b"]).count() == 1


def test_rooms_and_sensors(readings):
    assert [r.room for r in dashboard.room_list(readings).collect()] == ["a", "b"]
    assert [r.sensor_id for r in dashboard.sensor_list(readings).collect()] == ["s1", "s2", "s3"]


def test_range_includes_both_ends(readings):
    assert dashboard.select_range(readings, at(1), at(5)).count() == 3
    assert dashboard.select_range(readings).count() == 6


def test_minute_series(readings):
    rows = dashboard.series_by_minute(readings, ["b"]).collect()
    assert [(r.metric, r.value) for r in rows] == [("b", 1.5), ("b", 60.5)]


def test_labelled_series(spark):
    frame = spark.createDataFrame([(at(0), "b", 3.0, 2.005)],
                                  "bucket timestamp, room string, max_temp double, avg_temp double")
    rows = dashboard.series_of_windows(frame).collect()
    assert [(r.metric, r.value) for r in rows] == [("b avg", 2.01), ("b max", 3.0)]


def test_hour_series_and_pivot(readings):
    series = dashboard.series_by_hour(rollup.hourly(readings))
    wide = dashboard.one_column_per_metric(series, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in wide] == [(7.0, 31.0), (-2.25, None)]


def test_alert_log_limits_and_orders(spark):
    rows = [(at(i), "r", at(i), 26.04, 3) for i in range(5)]
    frame = spark.createDataFrame(
        rows, "time timestamp, room string, window_start timestamp, max_temp double, "
              "consecutive_count int")
    found = dashboard.alert_log(frame, limit=2).collect()
    assert [r.time.minute for r in found] == [4, 3] and found[0].max_temp == 26.0


def test_bands(spark):
    frame = spark.createDataFrame([(t,) for t in (-3.0, 17.9, 18.0, 23.9, 24.0, 27.0)], "t double")
    assert [r[0] for r in frame.select(dashboard.band(F.col("t"))).collect()] == [
        "blue", "blue", "green", "green", "yellow", "red"]


def test_numeric_round(spark):
    cases = [(1.005, 2, 1.01), (-1.005, 2, -1.01), (2.675, 2, 2.68), (22.004999999999999, 2, 22.01),
             (1e-20, 2, 0.0), (123456789.125, 2, 123456789.13)]
    for value, digits, expected in cases:
        frame = spark.createDataFrame([(value,)], "x double")
        assert frame.select(numeric_round(F.col("x"), digits)).collect()[0][0] == expected
    special = spark.createDataFrame([(float("inf"),), (None,)], "x double")
    assert [r[0] for r in special.select(numeric_round(F.col("x"), 1)).collect()] == [
        float("inf"), None]
