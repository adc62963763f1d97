"""Streams over files: late rows, replay, restart, and equality with the batch twins."""

import random
import time

import pytest
from pyspark.sql import functions as F

from kelvane import schemas
from kelvane.operators import alerts, codec, windows
from kelvane.plans import fixtures as fx
from kelvane.sinks.topics import file_writer
from kelvane.sources import otlp, topics
from kelvane.sources.tables import scan
from kelvane.streaming import jobs
from kelvane.session import STATE_SETTINGS, conf_scope
from kelvane.streaming.detector import stream_alerts

ONCE = {"availableNow": True}
READING = ("sensor_id string, room string, temp_c double, humidity double, pressure double, "
           "time timestamp, partition int, offset bigint, position int")
FAR = 10_000_000  # seconds; closes every earlier window


def land(spark, path, rows):
    """One file of readings: (sensor, second, temp)."""
    spark.createDataFrame(
        [(s, "r", float(t), 1.0, 1.0, int(sec), 0, i, 0) for i, (s, sec, t) in enumerate(rows)],
        READING.replace("time timestamp", "time bigint"),
    ).withColumn("time", F.timestamp_seconds("time")).select(
        *[c.split()[0] for c in READING.split(", ")]).coalesce(1).write.mode("append").parquet(path)


def readings(spark, path):
    return spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(path)


def finish(query):
    query.awaitTermination()
    return query


def buckets(spark, root):
    found = scan(spark, root, "readings_aggregated").select(
        F.unix_seconds("bucket"), "max_temp", "avg_temp").collect()
    return sorted(map(tuple, found))


def test_late_row_misses_its_window_but_is_stored(spark, root, tmp_path):
    path = str(tmp_path / "in")
    for file in ([("a", 10, 1.0), ("a", 299, 3.0)], [("a", 310, 5.0)],
                 [("a", 50, 99.0), ("a", FAR, 0.0)]):
        land(spark, path, file)
        finish(jobs.start_window_job(readings(spark, path), root, str(tmp_path / "w"), ONCE))
        finish(jobs.start_raw_job(readings(spark, path), root, str(tmp_path / "r"), ONCE))
    assert buckets(spark, root) == [(0, 3.0, 2.0), (300, 5.0, 5.0)]
    assert scan(spark, root, "readings_raw").count() == 5


def test_replay_makes_no_duplicates(spark, root, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [("a", s, float(s)) for s in range(0, 3000, 100)] + [("a", FAR, 0.0)])
    for attempt in range(2):
        finish(jobs.start_window_job(readings(spark, path), root, str(tmp_path / f"w{attempt}"), ONCE))
        finish(jobs.start_raw_job(readings(spark, path), root, str(tmp_path / f"r{attempt}"), ONCE))
    assert scan(spark, root, "readings_raw").count() == 31
    assert len(buckets(spark, root)) == 10
    repeated = scan(spark, root, "readings_raw").groupBy("sensor_id", "time").count()
    assert repeated.filter("count > 1").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_their_batch_twin_in_any_file_order(spark, root, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(f"s{rng.randrange(3)}", s, rng.randrange(100)) for s in range(0, 2000, 20)]
    # Shuffled within a span shorter than the allowed delay.
    rows.sort(key=lambda r: r[1] + rng.uniform(0, 9))
    path = str(tmp_path / "in")
    for i in range(0, len(rows), 30):
        land(spark, path, rows[i:i + 30])
    land(spark, path, [("a", FAR, 0.0)])
    finish(jobs.start_window_job(
        readings(spark, path), root, str(tmp_path / "w"), ONCE, topic=file_writer(str(tmp_path / "t"))))
    twin = windows.as_table_rows(windows.tumble(spark.read.schema(READING).parquet(path)))
    expected = twin.filter(F.unix_seconds("bucket") < FAR - 300).drop("event_date")
    stored = scan(spark, root, "readings_aggregated").drop("event_date")
    assert sorted(stored.collect()) == sorted(expected.collect())
    published = codec.read_messages(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(published.collect()) == sorted(
        windows.from_table_rows(expected).collect())


def results_frame(spark, rows):
    return spark.createDataFrame(
        [(room, b, float(t), 0.0, 0.0, 0.0) for room, b, t in rows], schemas.WINDOW_RESULT)


def test_alerts_survive_a_restart_and_equal_the_batch_twin(spark, root, tmp_path):
    rng = random.Random(3)
    temps = [rng.choice([20, 26, 27, 28]) for _ in range(60)]
    temps[10] = float("nan")
    rows = [(room, i * 300_000, t) for i, t in enumerate(temps) for room in ("a", "b")]
    rows[20:20] = rows[18:20] * 2  # windows 9 of both rooms come three times
    path = str(tmp_path / "in")
    for i in range(0, len(rows), 24):  # the state is restored for every part
        results_frame(spark, rows[i:i + 24]).write.mode("append").parquet(path)
        source = spark.readStream.schema(schemas.WINDOW_RESULT).parquet(path)
        finish(jobs.start_alert_job(
            source, root, str(tmp_path / "c"), ONCE, topic=file_writer(str(tmp_path / "t"))))
    stored = scan(spark, root, "alerts").select(
        "room", F.unix_millis("window_start").alias("window_start_ms"), "max_temp",
        "consecutive_count")
    expected = alerts.detect_alerts(results_frame(spark, rows))
    assert sorted(stored.collect()) == sorted(expected.collect())
    published = codec.read_messages(spark.read.parquet(str(tmp_path / "t")), schemas.ALERT)
    assert sorted(published.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("cap", [1, 3, 1000])
def test_runs_do_not_depend_on_files_or_batches(spark, root, tmp_path, cap):
    """A topic of several files a commit, read in parts; file times run backwards."""
    import os
    rooms = [f"r{i}" for i in range(20)]
    rng = random.Random(cap)
    temps = {r: [rng.choice([20, 26, 27, 28]) for _ in range(12)] for r in rooms}
    topic = str(tmp_path / "topic")
    for commit in range(3):
        rows = [(r, i * 300_000, temps[r][i]) for r in rooms for i in range(commit * 4, commit * 4 + 4)]
        rng.shuffle(rows)
        before = set(os.listdir(topic)) if commit else set()
        file_writer(topic)(codec.window_messages(results_frame(spark, rows)))
        new = sorted(f for f in set(os.listdir(topic)) - before if f.startswith("part-"))
        for place, name in enumerate(new):
            at = 1_700_000_000 + commit * 1000 - place
            os.utime(f"{topic}/{name}", (at, at))
    source = jobs.windows_of_messages(topics.file_topic(spark, topic, cap))
    finish(jobs.start_alert_job(source, root, str(tmp_path / "c"), ONCE))
    stored = scan(spark, root, "alerts").select(
        "room", F.unix_millis("window_start").alias("window_start_ms"), "max_temp", "consecutive_count")
    expected = alerts.detect_alerts(results_frame(
        spark, [(r, i * 300_000, t) for r in rooms for i, t in enumerate(temps[r])]))
    assert sorted(stored.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("options", [{"gap_resets": True}, {"dedupe": True}, {"gap_resets": True, "dedupe": True}])
def test_stream_options_equal_their_batch_twin(spark, root, tmp_path, options):
    rng = random.Random(5)
    steps = [i for i in range(60) if i % 11 != 5]
    rows = [("a", i * 300_000, rng.choice([20, 26, 27, 28])) for i in steps]
    sent = [r for r in rows for _ in range(2 if options.get("dedupe") and r[1] % 4 == 0 else 1)]
    topic = str(tmp_path / "topic")
    for i in range(0, len(sent), 7):
        file_writer(topic)(codec.window_messages(results_frame(spark, sent[i:i + 7])))
    source = jobs.windows_of_messages(topics.file_topic(spark, topic, 2))
    finish(jobs.start_alert_job(source, root, str(tmp_path / "c"), ONCE, **options))
    stored = scan(spark, root, "alerts").select(
        "room", F.unix_millis("window_start").alias("window_start_ms"), "max_temp", "consecutive_count")
    expected = alerts.detect_alerts(results_frame(spark, sent), **options)
    assert sorted(stored.collect()) == sorted(expected.collect())


def test_rejects_of_an_earlier_checkpoint_stay(spark, root, tmp_path):
    for attempt in range(2):
        topic = str(tmp_path / f"topic-{attempt}")
        spark.createDataFrame([(None, b"x", 0, attempt)], schemas.TOPIC).write.parquet(topic)
        finish(jobs.start_payload_job(topics.file_topic(spark, topic), root, str(tmp_path / "bad"),
                                      str(tmp_path / f"c{attempt}"), ONCE))
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == [0, 1]


def test_payload_counts_are_logged(spark, root, tmp_path, caplog):
    topic = str(tmp_path / "topic")
    spark.createDataFrame([(None, b"x", 0, 0), (None, b"", 0, 1)], schemas.TOPIC).write.parquet(topic)
    with caplog.at_level("INFO", "kelvane.streaming.jobs"):
        finish(jobs.start_payload_job(topics.file_topic(spark, topic), root, str(tmp_path / "bad"),
                                      str(tmp_path / "c"), ONCE))
        for _ in range(100):  # the progress of a query is told behind its end
            if caplog.text:
                break
            time.sleep(0.1)
    assert "0 payloads accepted, 2 rejected" in caplog.text


def test_alert_settings(spark, tmp_path):
    path = str(tmp_path / "in")
    results_frame(spark, [("a", i * 300_000, t) for i, t in enumerate((31, 32, 29, 33))]
                  ).write.parquet(path)
    source = spark.readStream.schema(schemas.WINDOW_RESULT).parquet(path)
    with conf_scope(spark, STATE_SETTINGS):
        query = (stream_alerts(source, threshold=30.0, consecutive=2).writeStream
                 .format("memory").queryName("settings_out").outputMode("append")
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start())
    finish(query)
    assert [r.consecutive_count for r in spark.table("settings_out").collect()] == [2]


def test_payload_job_splits_good_and_bad(spark, root, tmp_path):
    topic = str(tmp_path / "topic")
    good = ('{"schema_version":"1","sensor_id":"s","room":"r","temp_c":1.5,"humidity":2,'
            '"pressure":3,"timestamp_ms":1622505600250}')
    spark.createDataFrame(
        [(None, v.encode(), 0, i) for i, v in enumerate([good, "x", good.replace("1.5", "9.5")])],
        schemas.TOPIC).write.parquet(topic)
    finish(jobs.start_payload_job(
        topics.file_topic(spark, topic), root, str(tmp_path / "bad"), str(tmp_path / "c"), ONCE))
    (row,) = scan(spark, root, "readings_raw").collect()
    assert (row.sensor_id, row.temp_c, row.humidity) == ("s", 1.5, 2.0)
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [(r.offset, r.reject_reason) for r in bad] == [(1, "malformed_json")]


def test_landed_text_payloads(spark, root, tmp_path):
    lines = tmp_path / "landed"
    lines.mkdir()
    (lines / "a.json").write_text(
        '{"schema_version":"1","sensor_id":"s","room":"r","temp_c":1,"humidity":2,'
        '"pressure":3,"timestamp_ms":1622505600250}\nnot json\n')
    source = jobs.readings_of_payloads(topics.text_topic(spark, str(lines)))
    finish(jobs.start_raw_job(source, root, str(tmp_path / "c"), ONCE))
    assert scan(spark, root, "readings_raw").count() == 1


def test_batch_topic_to_alerts(spark, root, tmp_path):
    """All jobs in a row, each reading what the one before stored."""
    frame = spark.range(40).select(
        F.col("id").alias("arrival"), F.lit("s").alias("sensor_id"), F.lit("r").alias("room"),
        (F.col("id") + 10.0).alias("temp_c"), F.lit(1.0).alias("humidity"),
        F.lit(2.0).alias("pressure"), F.timestamp_seconds(F.col("id") * 300 + 3000).alias("time"))
    coded = otlp.encode_batches(fx.bent_batches(frame)).select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit(0).alias("partition"),
        F.col("batch").alias("offset"))
    coded.write.parquet(str(tmp_path / "topic"))
    source = jobs.readings_of_batches(topics.file_topic(spark, str(tmp_path / "topic")), native=False)
    finish(jobs.start_raw_job(source, root, str(tmp_path / "raw"), ONCE))
    finish(jobs.start_window_job(source, root, str(tmp_path / "win"), ONCE,
                                 topic=file_writer(str(tmp_path / "t"))))
    closed = jobs.windows_of_messages(topics.file_topic(spark, str(tmp_path / "t")))
    finish(jobs.start_alert_job(closed, root, str(tmp_path / "al"), ONCE))
    lost = 8  # remainders 2 and 3 of 11 among 40
    assert scan(spark, root, "readings_raw").count() == 40 - lost
    expected = alerts.detect_alerts(windows.from_table_rows(scan(spark, root, "readings_aggregated")))
    assert scan(spark, root, "alerts").count() == expected.count() > 0


def test_snapshot_job_writes_every_sensor_at_every_tick(spark, tmp_path):
    path = str(tmp_path / "in")
    ticks = str(tmp_path / "ticks")
    for file in ([("a", 1, 1.0), ("b", 2, 2.0)], [("a", 3, 3.0)]):
        land(spark, path, file)
        source = readings(spark, path).withColumn("ts_nanos", F.unix_millis("time") * 1_000_000)
        finish(jobs.start_snapshot_job(
            source, ticks, str(tmp_path / "c"), arrival=("time",), trigger=ONCE))
    rows = spark.read.parquet(ticks).select("batch", "sensor_id", "temp_c").collect()
    assert sorted(map(tuple, rows)) == [(0, "a", 1.0), (0, "b", 2.0), (1, "a", 3.0), (1, "b", 2.0)]
