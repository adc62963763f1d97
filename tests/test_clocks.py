"""Watermarks per source partition, ticks without news, sessions, streams that start from state."""

import random
import time

import pandas as pd
from pyspark.sql import functions as F

from kelvane import schemas
from kelvane.operators import alerts, codec, windows
from kelvane.session import STATE_SETTINGS, conf_scope
from kelvane.sinks.topics import file_writer
from kelvane.sources import topics
from kelvane.sources.tables import scan
from kelvane.streaming import clocks, detector, jobs

ONCE = {"availableNow": True}
READING = "room string, second bigint, temp_c double, humidity double, partition int"
DATED = ("sensor_id string, room string, temp_c double, humidity double, pressure double, time timestamp, "
         "partition int, offset bigint, ts_nanos bigint, arrival bigint")


def readings(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "arrival bigint, " + READING)
    return frame.select(
        F.lit("s").alias("sensor_id"), "room", "temp_c", "humidity", F.lit(1.0).alias("pressure"),
        F.timestamp_seconds("second").alias("time"), "partition", F.col("arrival").alias("offset"),
        (F.col("second") * 1_000_000_000).alias("ts_nanos"), "arrival")


def land(spark, path, rows):
    readings(spark, rows).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(DATED).option("maxFilesPerTrigger", 1).parquet(path)


def run(frame, folder, trigger=None):
    with conf_scope(frame.sparkSession, jobs.timer_settings(trigger or ONCE)):
        query = frame.writeStream.outputMode("append").format("parquet").option(
            "checkpointLocation", f"{folder}/cp").trigger(**(trigger or ONCE)).start(f"{folder}/out")
    return query


def finished(frame, folder):
    run(frame, folder).awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/out")


def by_text(frame):
    return sorted(map(repr, frame.collect()))


def test_slowest_partition_closes_windows(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [("r", 10, 1.0, 1.0, 0), ("r", 9000, 2.0, None, 0), (None, 20, 7.0, float("nan"), 0),
                       ("r", 15, float("nan"), None, 1), ("q", 40, float("inf"), None, 1)])
    land(spark, path, [("r", 50, 5.0, 3.0, 1), ("r", 650, 6.0, 4.0, 1)])
    land(spark, path, [("r", 60, 50.0, 3.0, 0), ("r", 400, 7.0, 1.0, 0), ("late", 100, 1.0, 1.0, 0)])
    found = finished(clocks.tumble_by_partition(stream(spark, path), shards=3), str(tmp_path))
    # After the second file partition 1 stands at 650 - 10 s: the third file is late for the first two windows.
    kept = spark.read.schema(DATED).parquet(path).filter("NOT (partition = 0 AND time > timestamp_seconds(20) "
                                                         "AND time < timestamp_seconds(600))")
    expected = windows.tumble(kept).filter("bucket_ms < 600000")
    assert by_text(found.select(*expected.columns)) == by_text(expected) and expected.count() == 3


def test_silent_partition_is_let_go(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [("r", 10, 1.0, 1.0, 0), ("r", 20, 2.0, 1.0, 1), ("r", 9000, 3.0, 1.0, 0)])
    frame = clocks.tumble_by_partition(stream(spark, path), idle="2 seconds", partitions=(0, 1, 2), shards=2)
    query = run(frame, str(tmp_path), {"processingTime": "500 milliseconds"})
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not query.exception():
            # Only partition 0 has news from here on.
            land(spark, path, [("r", 9000 + int(time.time() % 1000), 3.0, 1.0, 0)])
            if spark.read.schema(frame.schema).parquet(f"{tmp_path}/out").filter("bucket_ms = 0").count():
                break
            time.sleep(1)
    finally:
        query.stop()
    (row,) = spark.read.parquet(f"{tmp_path}/out").filter("bucket_ms = 0").collect()
    assert (row.max_temp, row.avg_temp) == (2.0, 1.5)


def test_window_job_by_partition_restarts(spark, root, tmp_path):
    """A partition that comes back after a restart is still within its own watermark."""
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    land(spark, path, [("r", s, float(s), 1.0, 0) for s in range(0, 3000, 100)] + [("r", 5, 9.0, 1.0, 1)])
    start = lambda: jobs.start_window_job(
        stream(spark, path), root, checkpoint, ONCE, by_partition=True, idle="1 hour", topic=file_writer(f"{tmp_path}/t"))
    start().awaitTermination()
    assert scan(spark, root, "readings_aggregated").count() == 0
    land(spark, path, [("r", s, float(s) + 1, 1.0, 1) for s in range(0, 3000, 100)])
    start().awaitTermination()
    stored = windows.from_table_rows(scan(spark, root, "readings_aggregated"))
    expected = windows.tumble(spark.read.schema(DATED).parquet(path)).filter("bucket_ms + 300000 <= 2890000")
    assert by_text(stored.select(*expected.columns)) == by_text(expected) and expected.count() == 9
    assert codec.read_messages(spark.read.schema(schemas.TOPIC).parquet(f"{tmp_path}/t")).count() == 9


def test_merging_states_equals_the_batch_form():
    rng = random.Random(4)
    value = lambda: rng.choice([None, float("nan"), 1.5, -2.0, 8.0])
    rows = pd.DataFrame([(rng.choice(["a", "b", None]), rng.randrange(3), value(), value()) for _ in range(200)],
                        columns=["room", "bucket_ms", "temp_c", "humidity"], dtype=object)
    for name in ("temp_c", "humidity"):
        rows[f"has_{name}"] = [x is not None for x in rows[name]]
    cut = [rows[:50], rows[50:51], rows[51:]]
    merged = clocks._merged([clocks._merged([clocks._as_state(part)]) for part in cut])
    assert len(merged) == len(clocks._merged([clocks._as_state(rows)]))
    for row in merged.itertuples():
        same = rows[[b == row.bucket_ms and r == row.room for b, r in zip(rows["bucket_ms"], rows["room"])]]
        given = [x for x in same["humidity"] if x is not None]
        assert row.n_humidity == len(given)
        top = max(given, key=lambda x: (x != x, x)) if given else float("-inf")
        assert repr(float(row.max_humidity)) == repr(float(top))


def test_ticks_go_on_while_every_sensor_is_silent(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [("r", 10, 1.0, None, 0), ("q", 20, 2.0, 5.0, 0), ("r", 5, 4.0, None, 0)])
    query = jobs.start_tick_job(stream(spark, path), f"{tmp_path}/ticks", f"{tmp_path}/cp", "2 seconds",
                                trigger={"processingTime": "500 milliseconds"})
    read = lambda: spark.read.option("recursiveFileLookup", "true").schema(
        clocks.SNAPSHOT + ", tick timestamp").parquet(f"{tmp_path}/ticks").collect()
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not query.exception():
            time.sleep(2)
            rows = read() if list(tmp_path.glob("ticks/*/*/_SUCCESS")) else []
            if len(rows) >= 8:
                break
    finally:
        query.stop()
    by_room = {room: sorted(r.tick for r in rows if r.room == room) for room in ("q", "r")}
    for ticks in by_room.values():
        assert len(ticks) >= 3 and {(b - a).total_seconds() for a, b in zip(ticks, ticks[1:])} == {2.0}
    # The reading that arrived last, not the newest.
    assert {(r.room, r.temp_c, r.humidity, r.ts_nanos) for r in rows} == {
        ("q", 2.0, 5.0, 20_000_000_000), ("r", 4.0, None, 5_000_000_000)}


def test_sessions_of_a_table(spark):
    rows = [("r", 0, 1.0), ("r", 60, 2.0), ("r", 121, 3.0), ("slow", 0, 1.0), ("slow", 300, float("nan")), ("r", 60, None),
            ("slow", 601, 5.0), (None, 5, 1.0), ("x", -30, float("inf"))]
    frame = readings(spark, [(room, s, t, None, 0) for room, s, t in rows])
    found = windows.sessions(frame, "60 seconds", {"slow": "5 minutes"}).select(
        "room", F.col("start_ms") / 1000, F.col("end_ms") / 1000, "n", "max_temp", "avg_temp")
    nan = float("nan")
    assert sorted(repr(tuple(r)) for r in found.collect()) == sorted(map(repr, [
        ("r", 0.0, 120.0, 3, 2.0, 1.5), ("r", 121.0, 181.0, 1, 3.0, 3.0), ("slow", 0.0, 600.0, 2, nan, nan),
        ("slow", 601.0, 901.0, 1, 5.0, 5.0), (None, 5.0, 65.0, 1, 1.0, 1.0), ("x", -30.0, 30.0, 1, 0.0, float("inf"))]))
    assert windows.sessions(frame.limit(0)).count() == 0


def test_late_reading_joins_two_sessions_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [("r", 0, 1.0, None, 0), ("r", 100, 2.0, None, 0)])
    land(spark, path, [("r", 50, 9.0, None, 0)])
    land(spark, path, [("r", 9000, 0.0, None, 0)])
    with conf_scope(spark, STATE_SETTINGS):
        frame = windows.sessions(stream(spark, path), "1 minute", watermark="5 minutes")
        query = frame.writeStream.outputMode("append").format("parquet").option(
            "checkpointLocation", f"{tmp_path}/cp").trigger(**ONCE).start(f"{tmp_path}/out")
    query.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("r", 0, 160_000, 3, 9.0, 4.0)]


def test_stream_goes_on_from_the_runs_of_another(spark, root, tmp_path):
    """Runs read back from one checkpoint, and from stored windows, start another."""
    rng = random.Random(9)
    rows = [(room, i * 300_000, rng.choice([20.0, 30.0, 31.0])) for room in "ab" for i in range(60)]
    frame = spark.createDataFrame(rows, "room string, bucket_ms bigint, max_temp double").withColumns(
        {c: F.lit(None).cast("double") for c in ("avg_temp", "max_humidity", "avg_humidity")})
    first, second = frame.filter("bucket_ms < 9000000"), frame.filter("bucket_ms >= 9000000")

    def go(part, name, runs=None):
        file_writer(f"{tmp_path}/{name}-topic")(codec.window_messages(part))
        topic = jobs.windows_of_messages(topics.file_topic(spark, f"{tmp_path}/{name}-topic"))
        jobs.start_alert_job(topic, root, f"{tmp_path}/{name}", ONCE, runs=runs).awaitTermination()

    go(first, "first")
    go(second, "second", detector.stored_runs(spark, f"{tmp_path}/first"))
    expected = alerts.detect_alerts(frame).select("room", "window_start_ms", "consecutive_count")
    found = scan(spark, root, "alerts").select("room", F.unix_millis("window_start"), "consecutive_count")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert by_text(detector.stored_runs(spark, f"{tmp_path}/first")) == by_text(alerts.run_state(first))
