import json

import pytest
from pyspark.sql import functions as F

from kelvane.operators import metrics, payload

GOOD = {"schema_version": "1", "sensor_id": "probe-7", "room": "attic", "temp_c": 18.75,
        "humidity": 41.5, "pressure": 987.25, "timestamp_ms": 1622505600250}


def text(**changes) -> bytes:
    merged = {**GOOD, **changes}
    return json.dumps({k: v for k, v in merged.items() if v is not ...}).encode()


def decode(spark, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value binary")
    return payload.parse_payloads(frame).orderBy("n").collect()


BAD = [
    (None, "empty"),
    (b"", "empty"),
    (b"{sensor: ?", "malformed_json"),
    (b"{\xc0\xaf}", "invalid_utf8"),
    (text(schema_version="2"), "unsupported_version"),
    (text(schema_version=1), "type:schema_version"),
    (text(temp_c=...), "missing:temp_c"),
    (text(temp_c=None), "type:temp_c"),
    (text(temp_c="1.5"), "type:temp_c"),
    (text(room=5), "type:room"),
    (text(timestamp_ms=5.0), "type:timestamp_ms"),
    (text(timestamp_ms=-5), "type:timestamp_ms"),
    (text(timestamp_ms="5"), "type:timestamp_ms"),
    (text(timestamp_ms=2**63), "type:timestamp_ms"),
    (text(timestamp_ms=2**64 // 1_000_000 + 1), "time_overflow"),
    (text(pressure=float("nan")), "malformed_json"),
    (text().replace(b"987.25", b"1e400"), "type:pressure"),
    (text().replace(b'"', b"'"), "malformed_json"),
    (text().replace(b'"room"', b'"room": "x", "room"'), "malformed_json"),
    (b"[" + text() + b"]", "not_an_object"),
    (b"5", "not_an_object"),
    (b'["1", "s", "r", 1.0, 2.0, 3.0, 5]', "not_an_object"),
    (text() + b" x}", "malformed_json"),
    (text() + b"," + text(), "malformed_json"),
    (text() + b"] x", "malformed_json"),
    (text() + b', "1"', "malformed_json"),
    (text()[:-1], "malformed_json"),
]


@pytest.fixture(scope="module")
def bad_rows(spark):
    return decode(spark, *[value for value, _ in BAD])


@pytest.mark.parametrize("i", range(len(BAD)), ids=[f"{i}-{r}" for i, (_, r) in enumerate(BAD)])
def test_rejected(bad_rows, i):
    assert bad_rows[i].reading is None
    assert bad_rows[i].reject_reason == BAD[i][1]


def test_valid_payload_keeps_its_values(spark):
    (row,) = decode(spark, text())
    assert row.reject_reason is None
    assert row.reading.asDict() == GOOD


@pytest.mark.parametrize("value", [
    text(battery_mv=3300), text(nested={"a": [1, {"b": "}"}]}), b" \n" + text() + b"\t ",
    text(temp_c=22), text().replace(b"18.75", b"1.875e1"), text(sensor_id="", room="a }"),
])
def test_accepted_forms(spark, value):
    (row,) = decode(spark, value)
    assert row.reject_reason is None


def test_six_sensors(spark):
    names = ["attic", "cellar", "hall", "porch", "studio", "workshop"]
    rows = decode(spark, *[text(sensor_id=f"probe-{n}", room=n) for n in names])
    assert [r.reading.sensor_id for r in rows] == [f"probe-{n}" for n in names]


def test_nanoseconds(spark):
    frame = spark.createDataFrame(
        [(text(),), (text(timestamp_ms=2**63 // 1_000_000 + 1),)], "value binary")
    rows = payload.accepted(payload.parse_payloads(frame)).orderBy("timestamp_ms").collect()
    assert rows[0].ts_nanos == 1622505600250000000
    assert rows[1].ts_nanos == 2**63 - 1  # does not fit a signed long


def test_outcome_counters(spark):
    frame = spark.createDataFrame([(text(),), (b"x",), (b"",)], "value binary")
    counted = payload.count_outcomes(payload.parse_payloads(frame), "seen")
    from pyspark.sql import Observation
    watch = Observation("again")
    counted.observe(watch, F.count_if(F.col("reject_reason").isNull()).alias("good")).collect()
    assert watch.get == {"good": 1}


def test_rejects_keep_the_value(spark):
    frame = spark.createDataFrame([(b"\xff\xfe\x00",)], "value binary")
    (row,) = payload.rejected(payload.parse_payloads(frame)).collect()
    assert bytes(row.value) == b"\xff\xfe\x00"


def test_round_trip(spark):
    frame = spark.createDataFrame([(text(),)], "value binary")
    good = payload.accepted(payload.parse_payloads(frame))
    again = payload.accepted(payload.parse_payloads(payload.encode_payloads(good)))
    assert again.drop("value").collect() == good.drop("value").collect()


def test_metric_rows_and_units(spark):
    frame = spark.createDataFrame([(text(),)], "value binary")
    good = payload.accepted(payload.parse_payloads(frame))
    rows = metrics.with_units(metrics.metric_rows(good)).collect()
    assert {(r.metric, r.value, r.unit) for r in rows} == {
        ("room.temperature", 18.75, "Cel"), ("room.humidity", 41.5, "%"),
        ("room.pressure", 987.25, "hPa")}
    assert {r.ts_nanos for r in rows} == {1622505600250000000}


def snapshot_input(spark):
    return spark.createDataFrame([
        # arrival, arrival second, event nanos: the last arrival wins, not the newest event
        ("a", "x", 1.0, 10.0, 100.0, 9 * 10**6, 1, 3), ("a", "x", 2.0, 20.0, 200.0, 5 * 10**6, 2, 14),
        ("b", "x", 3.0, 30.0, 300.0, 10**6, 3, 41),
    ], "sensor_id string, room string, temp_c double, humidity double, pressure double, "
       "ts_nanos bigint, arrival bigint, second bigint").withColumn(
        "arrival_time", F.timestamp_seconds("second"))


def test_last_arrival_wins(spark):
    rows = metrics.latest_snapshot(snapshot_input(spark)).collect()
    assert {(r.sensor_id, r.temp_c, r.ts_nanos) for r in rows} == {
        ("a", 2.0, 5 * 10**6), ("b", 3.0, 10**6)}
    by_struct = metrics.latest_snapshot(snapshot_input(spark), ("second", "arrival")).collect()
    assert {(r.sensor_id, r.temp_c) for r in by_struct} == {("a", 2.0), ("b", 3.0)}


def test_sampling_repeats_silent_sensors(spark):
    rows = metrics.sampled_snapshot(snapshot_input(spark)).select(
        F.unix_seconds("tick").alias("t"), "sensor_id", "temp_c").collect()
    assert sorted(map(tuple, rows)) == [
        (10, "a", 1.0), (20, "a", 2.0), (30, "a", 2.0), (40, "a", 2.0), (50, "a", 2.0),
        (50, "b", 3.0)]


def test_batches_split_by_sensor_count(spark):
    snap = metrics.sampled_snapshot(snapshot_input(spark))
    small = metrics.assemble_batches(snap, shards=4)
    whole = metrics.assemble_batches(snap)
    assert whole.count() == 5 and small.count() in (5, 6)
    from kelvane.operators.batch import flatten_batches
    columns = ["sensor_id", "room", "temp_c", "humidity", "pressure"]
    left, right = (sorted(flatten_batches(b, "all").select(*columns).collect())
                   for b in (small, whole))
    assert left == right and len(left) == 6


def test_messages_stay_small_with_many_sensors(spark):
    snap = spark.range(3000).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("sensor_id"), F.lit("r").alias("room"),
        F.lit(10**15).alias("ts_nanos"), F.col("id").cast("double").alias("temp_c"), F.lit(1.0).alias("humidity"),
        F.lit(2.0).alias("pressure"), F.when(F.col("id") < 2990, 60).otherwise(120).cast("timestamp").alias("tick"))
    from kelvane.operators.batch import flatten_batches
    for shards in (1, 3):
        nested = metrics.assemble_batches(snap, shards, most=100)
        points = F.size(F.col("resource_metrics")[0]["scope_metrics"][0]["metrics"][0]["gauge"]["data_points"])
        sizes = nested.select("tick", points.alias("n")).collect()
        assert sum(r.n for r in sizes) == 3000 and max(r.n for r in sizes) < 200
        assert sum(r.tick.minute == 2 for r in sizes) <= shards
        found = flatten_batches(nested, "all").select("sensor_id", "temp_c").collect()
        assert len(found) == 3000 and {(r.sensor_id, r.temp_c) for r in found} == {
            (f"s{i}", float(i)) for i in range(3000)}
