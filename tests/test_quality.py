import random

from pyspark.sql import functions as F

from kelvane.operators import quality


def test_fields_and_types(spark):
    full = ('{"schema_version":"1","sensor_id":"s","room":"r","temp_c":1,"humidity":2,'
            '"pressure":3,"timestamp_ms":5}')
    values = [full, full.replace('"room"', '"place"'), full.replace('"1"', "1"),
              full.replace(":5", ":5.5"), "[]", "x"]
    frame = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    fields = quality.field_mismatches(frame, keep=("n",)).orderBy("n").collect()
    assert [(r.n, len(r.missing), r.unexpected) for r in fields] == [
        (1, 1, ["place"]), (4, 7, []), (5, 7, [])]
    types = quality.type_mismatches(frame, keep=("n",)).orderBy("n").collect()
    assert [(r.n, r.version_type, r.time_type) for r in types] == [
        (2, "BIGINT", "BIGINT"), (3, "STRING", "DECIMAL"), (4, "ABSENT", "ABSENT")]


def test_ranges(spark):
    frame = spark.createDataFrame(
        [("a", 15.0, 0.0), ("a", 30.1, 50.0), ("b", 20.0, 100.0), ("c", 1.0, 101.0)],
        "sensor_id string, temp_c double, humidity double")
    rows = quality.out_of_range(frame).orderBy("sensor_id").collect()
    assert [tuple(r) for r in rows] == [("a", 1, 0), ("c", 1, 1)]


def test_registry_checks(spark):
    seen = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "sensor_id string, room string")
    assert [r.sensor_id for r in quality.sensors_in_many_rooms(seen).collect()] == ["a"]
    assert [r.sensor_id for r in quality.repeated_ids(seen).collect()] == ["a"]
    expected = spark.createDataFrame([("b",), ("z",)], "sensor_id string")
    assert [r.sensor_id for r in quality.absent(expected, seen, ["sensor_id"]).collect()] == ["z"]


def test_cadence_against_brute_force(spark):
    rng = random.Random(5)
    times = {s: [rng.randrange(20_000_000) for _ in range(60)] for s in ("a", "b")}
    times["a"].append(times["a"][0])  # a repeated time is a gap of zero
    times["c"] = [5]
    times["d"] = [7, 7, 7]
    frame = spark.createDataFrame(
        [(s, t) for s, ts in times.items() for t in ts], "sensor_id string, ms bigint"
    ).withColumn("time", F.timestamp_millis("ms"))
    rows = {r.sensor_id: r for r in quality.cadence(frame).collect()}
    for sensor in ("a", "b", "d"):
        ordered = sorted(times[sensor])
        gaps = [b - a for a, b in zip(ordered, ordered[1:])]
        row = rows[sensor]
        assert (row.readings, row.min_gap_ms, row.max_gap_ms) == (len(ordered), min(gaps), max(gaps))
        assert abs(row.mean_gap_ms - sum(gaps) / len(gaps)) < 1e-6
    assert "c" not in rows


def test_window_and_alert_checks(spark):
    frame = spark.createDataFrame(
        [("r", 0, 20.0, 19.0), ("r", 300_001, 20.0, 19.0), ("r", 600_000, 40.0, 19.0)],
        "room string, bucket_ms bigint, max_temp double, avg_temp double")
    assert [r.bucket_ms for r in quality.misaligned_buckets(frame).collect()] == [300_001]
    assert [r.bucket_ms for r in quality.implausible_windows(frame).collect()] == [600_000]
    raised = spark.createDataFrame([("r", 1), (None, 2)], "room string, n int")
    assert tuple(quality.alert_summary(raised).collect()[0]) == (2, 1)
    assert tuple(quality.alert_summary(raised.limit(0)).collect()[0]) == (0, 0)


def test_stuck_and_volume(spark):
    frame = spark.createDataFrame(
        [("a", m, 20.0) for m in range(5)] + [("b", m, 20.0 + m) for m in range(5)] + [("c", 1, 9.0)],
        "sensor_id string, minute bigint, temp_c double"
    ).withColumn("time", F.timestamp_seconds(F.col("minute") * 60))
    (row,) = quality.stuck_sensors(frame).collect()
    assert (row.sensor_id, row.n, row.temp_c) == ("a", 5, 20.0)
    (day,) = quality.rows_per_day(frame).collect()
    assert day.n == 11
    late = frame.withColumn("arrival_time", F.timestamp_seconds(F.col("minute") * 66))
    assert {r.minute for r in quality.far_from_arrival(late).collect()} == {1, 2, 3, 4}
