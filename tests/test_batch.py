import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

import wire_runtime
from kelvane import schemas
from kelvane.operators import batch
from kelvane.sources import otlp, wire as wire_format

T0 = 1_700_000_000_000_000_000
T0_MS = 1_700_000_000_000


def attr(key, text=None, number=None):
    return {"key": key, "value": {"string_value": text, "int_value": number,
                                  "double_value": None, "bool_value": None}}


def ids(sensor=None, room=None):
    return ([attr("sensor_id", sensor)] if sensor is not None else []) + (
        [attr("room", room)] if room is not None else [])


def point(value, nanos=T0, attributes=(), as_int=None):
    return {"attributes": list(attributes), "time_unix_nano": nanos, "as_double": value,
            "as_int": as_int}


def gauge(name, *points):
    return {"name": name, "gauge": {"data_points": list(points)}}


def res(attributes, *metrics):
    return {"resource": {"attributes": attributes}, "scope_metrics": [{"metrics": list(metrics)}]}


def three(t, h, p, nanos=T0, attributes=()):
    return [gauge("room.temperature", point(t, nanos, attributes)),
            gauge("room.humidity", point(h, nanos, attributes)),
            gauge("room.pressure", point(p, nanos, attributes))]


def flatten(spark, resources, mode="first", missing="zero"):
    frame = spark.createDataFrame([(resources,)], schemas.OTLP_BATCH)
    rows = batch.flatten_batches(frame, mode, missing).orderBy(
        "position", "sensor_id", "timestamp_ms").collect()
    return [(r.sensor_id, r.room, r.temp_c, r.humidity, r.pressure, r.timestamp_ms) for r in rows]


def test_one_sensor(spark):
    assert flatten(spark, [res(ids("probe-7", "attic"), *three(18.75, 41.5, 987.25))]) \
        == [("probe-7", "attic", 18.75, 41.5, 987.25, T0_MS)]


def test_three_sensors(spark):
    names = [("probe-1", "hall"), ("probe-2", "porch"), ("probe-3", "cellar")]
    rows = flatten(spark, [res(ids(*n), *three(20.0, 50.0, 1000.0)) for n in names])
    assert [r[:2] for r in rows] == names


def test_no_sensor_id(spark):
    assert flatten(spark, [res([], *three(20.0, 50.0, 1000.0))]) == []


def test_ids_on_points(spark):
    on_points = ids("probe-on-point", "stairs")
    assert flatten(spark, [res([], *three(12.5, 50.0, 1000.0, attributes=on_points))])[0][:3] == (
        "probe-on-point", "stairs", 12.5)


def test_zero_and_negative_time(spark):
    assert flatten(spark, [res(ids("s", "r"), *three(1.0, 2.0, 3.0, nanos=n))
                           for n in (0, -5, 999_999)]) == []


def test_unknown_metric_is_ignored_but_sets_the_time(spark):
    metrics = three(14.0, 33.0, 990.5) + [gauge("room.noise", point(61.0, T0 + 5_000_000))]
    assert flatten(spark, [res(ids("s", "r"), *metrics)]) == [
        ("s", "r", 14.0, 33.0, 990.5, T0_MS + 5)]


def test_only_unknown_metrics_emit_zeros(spark):
    assert flatten(spark, [res(ids("s", "r"), gauge("room.co2", point(800.0)))]) == [
        ("s", "r", 0.0, 0.0, 0.0, T0_MS)]


def test_same_sensor_twice(spark):
    resources = [res(ids("s", "r"), *three(1.0, 2.0, 3.0)),
                 res(ids("s", "r"), *three(1.0, 2.0, 3.0, nanos=T0 + 1_000_000))]
    assert [r[5] for r in flatten(spark, resources)] == [T0_MS, T0_MS + 1]


def test_last_attribute_wins_on_resource_first_filled_on_points(spark):
    twice = ids("old", "r1") + ids("new", "r2")
    assert flatten(spark, [res(twice, *three(1.0, 2.0, 3.0))])[0][:2] == ("new", "r2")
    points = [gauge("room.temperature", point(1.0, attributes=ids("", "first"))),
              gauge("room.humidity", point(2.0, attributes=ids("second", "late")))]
    assert flatten(spark, [res([], *points)])[0][:2] == ("second", "first")


def test_non_text_id_reads_empty(spark):
    numbered = [attr("sensor_id", number=7), attr("room", "r")]
    assert flatten(spark, [res(numbered, *three(1.0, 2.0, 3.0))]) == []
    rows = flatten(spark, [res(numbered, *three(1.0, 2.0, 3.0, attributes=ids("p", "x")))])
    assert rows[0][:2] == ("p", "r")


def test_empty_room_passes(spark):
    assert flatten(spark, [res(ids("s"), *three(1.0, 2.0, 3.0))])[0][1] == ""


def test_later_metric_of_a_name_wins_and_integers_read_zero(spark):
    metrics = [gauge("room.temperature", point(1.0)), gauge("room.temperature", point(2.0)),
               gauge("room.humidity", point(None, as_int=5))]
    assert flatten(spark, [res(ids("s", "r"), *metrics)])[0][2:4] == (2.0, 0.0)


@pytest.mark.parametrize("missing, humidity", [("zero", 0.0), ("null", None)])
def test_absent_humidity(spark, missing, humidity):
    row = flatten(spark, [res(ids("s", "r"), gauge("room.temperature", point(1.0)))],
                  missing=missing)[0]
    assert row[2:5] == (1.0, humidity, humidity)


def test_gauges_without_points_are_skipped(spark):
    metrics = [gauge("room.temperature"), {"name": "room.humidity", "gauge": None}]
    assert flatten(spark, [res(ids("s", "r"), *metrics, *three(1.0, 2.0, 3.0))])[0][2:5] == (
        1.0, 2.0, 3.0)
    assert flatten(spark, [res(ids("s", "r"), *metrics)]) == []


def many_points(sensors=6):
    def series(name, base):
        return gauge(name, *[point(base + i, T0 + 1, ids(f"s{i}", f"r{i}") + [
            attr("timestamp_nanos", number=T0 + i * 1_000_000)]) for i in range(sensors)])
    return [res([attr("service.name", "x")], series("room.temperature", 10.0),
                series("room.humidity", 20.0), series("room.pressure", 30.0))]


def test_many_points_first(spark):
    assert flatten(spark, many_points()) == [("s0", "r0", 10.0, 20.0, 30.0, T0_MS)]


def test_many_points_all(spark):
    assert flatten(spark, many_points(), "all") == [
        (f"s{i}", f"r{i}", 10.0 + i, 20.0 + i, 30.0 + i, T0_MS + i) for i in range(6)]


def test_all_groups_by_sensor_room_and_time(spark):
    metrics = [
        gauge("room.temperature", point(1.0, T0, ids("a", "r")), point(2.0, T0, ids("a", "r")),
              point(3.0, T0 + 1_000_000, ids("a", "r")), point(9.0, T0, ids("", "r"))),
        gauge("room.humidity", point(4.0, T0 + 1_000_000, ids("a", "r"))),
        gauge("room.co2", point(5.0, T0 + 2_000_000, ids("a", "r")))]
    assert flatten(spark, [res([], *metrics)], "all", "null") == [
        ("a", "r", 2.0, None, None, T0_MS), ("a", "r", 3.0, 4.0, None, T0_MS + 1),
        ("a", "r", 0.0, None, None, T0_MS + 2)]


def test_null_and_empty_batches(spark):
    frame = spark.createDataFrame([(None,), ([],)], schemas.OTLP_BATCH)
    assert batch.flatten_batches(frame).count() == 0
    assert batch.flatten_batches(frame, "all").count() == 0


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        batch.flatten_batches(spark.createDataFrame([], schemas.OTLP_BATCH), "some")


wire = pytest.mark.skipif(not wire_runtime.available(), reason="no protobuf runtime")


def test_wire_round_trip(spark):
    resources = many_points() + [res(ids("s", "r"), gauge("room.humidity", point(None, as_int=-5)),
                                     {"name": "n", "gauge": None}, gauge("room.pressure"))]
    frame = spark.createDataFrame([(resources,)], schemas.OTLP_BATCH)
    again = otlp.decode_batches(otlp.encode_batches(frame), native=False)
    assert again.schema.fieldNames() == ["resource_metrics"]
    assert again.collect() == frame.collect()


def test_unreadable_bytes(spark):
    values = [b"\x0a\xff\x03\x7f\x4b\x22\x01", b"", None]
    frame = spark.createDataFrame([(v,) for v in values], "value binary")
    decoded = otlp.decode_batches(frame, native=False)
    assert decoded.filter(F.col("resource_metrics").isNotNull()).count() == 0
    assert batch.flatten_batches(decoded).count() == 0


def test_known_bytes():
    """A message written by hand from the public field numbers."""
    value = b"\x0a\x01s"                                   # string_value
    entry = b"\x0a\x09sensor_id" + b"\x12" + bytes([len(value)]) + value
    resource = b"\x0a" + bytes([len(entry)]) + entry
    number = b"\x19" + (1_000_000).to_bytes(8, "little") + b"\x21" + b"\x00" * 6 + b"\xf0\x3f"
    series = b"\x0a" + bytes([len(number)]) + number
    metric = b"\x0a\x01m" + b"\x2a" + bytes([len(series)]) + series
    scope = b"\x12" + bytes([len(metric)]) + metric
    rm = b"\x0a" + bytes([len(resource)]) + resource + b"\x12" + bytes([len(scope)]) + scope
    ((row,),) = read([b"\x0a" + bytes([len(rm)]) + rm])
    assert row["resource"]["attributes"][0]["value"]["string_value"] == "s"
    (found,) = row["scope_metrics"][0]["metrics"][0]["gauge"]["data_points"]
    assert (found["time_unix_nano"], found["as_double"]) == (1_000_000, 1.0)


@wire
def test_unsigned_time_reads_negative():
    data = wire_runtime.batch_bytes([res(ids("s", "r"), gauge("m", point(1.0, nanos=-7)))])
    assert wire_format.coded([res(ids("s", "r"), gauge("m", point(1.0, nanos=-7)))]) == data
    ((row,),) = read([data])
    assert row["scope_metrics"][0]["metrics"][0]["gauge"]["data_points"][0]["time_unix_nano"] == -7


KIND = to_arrow_type(schemas.RESOURCE_METRICS)


def read(values):
    return wire_format.resource_metrics(pa.array(values, pa.binary()), KIND).to_pylist()


def some_resources(rng):
    text = lambda: rng.choice(["", "a", "room é", "\U0001f600" * 40])
    def entry():
        value = dict.fromkeys(("string_value", "int_value", "double_value", "bool_value"))
        kind = rng.choice([*value, None])
        if kind:
            value[kind] = {"string_value": text(), "int_value": rng.randint(-2**63, 2**63 - 1),
                           "double_value": rng.choice([0.0, -1.5, float("inf")]), "bool_value": rng.random() < 0.5}[kind]
        return {"key": text(), "value": value}
    entries = lambda: [entry() for _ in range(rng.randint(0, 3))]
    def one_point():
        real = rng.random() < 0.5
        return {"attributes": entries(), "time_unix_nano": rng.choice([0, 7, -7, 2**62]),
                "as_double": rng.random() if real else None, "as_int": None if real else rng.choice([None, 0, -5])}
    def one_metric():
        points = rng.choice([None, [one_point() for _ in range(rng.choice([0, 1, 3, 40]))]])
        return {"name": text(), "gauge": None if points is None else {"data_points": points}}
    return [{"resource": {"attributes": entries()}, "scope_metrics": [
        {"metrics": [one_metric() for _ in range(rng.randint(0, 4))]} for _ in range(rng.randint(0, 2))]}
        for _ in range(rng.randint(0, 4))]


def test_wire_reader_returns_what_was_coded():
    rng = random.Random(1)
    batches = [some_resources(rng) for _ in range(60)]
    assert read([wire_format.coded(b) for b in batches]) == [b or None for b in batches]
    assert read([]) == [] and read([None, b""]) == [None, None]
    sliced = pa.array([b"xx", wire_format.coded(batches[0]), None, wire_format.coded(batches[1])], pa.binary())[1:]
    assert wire_format.resource_metrics(sliced, KIND).to_pylist() == [batches[0] or None, None, batches[1] or None]


def test_messages_are_read_and_coded_a_few_at_a_time(monkeypatch):
    rng = random.Random(2)
    batches = [some_resources(rng) for _ in range(300)]
    coded = pa.array([wire_format.coded(b) if i % 7 else None for i, b in enumerate(batches)], pa.binary())
    whole = wire_format.resource_metrics(coded, KIND)
    assert len(wire_format.Reader(coded.slice(8, 1)).data) == len(coded[8].as_py()) + wire_format._PAD
    held, reader = [], wire_format.Reader

    def noted(values):
        held.append(reader(values))
        return held[-1]

    monkeypatch.setattr(wire_format, "Reader", noted)
    monkeypatch.setattr(wire_format, "RUN_BYTES", 2000)
    assert wire_format.resource_metrics(coded, KIND).equals(whole)
    assert wire_format.resource_metrics(coded[250:], KIND).equals(whole[250:])
    longest = max(len(v) for v in coded.to_pylist() if v is not None)
    assert len(held) > 10 and max(len(r.data) for r in held) <= 2000 + longest + wire_format._PAD
    monkeypatch.setattr(wire_format, "CODED_ROWS", 7)
    nested = pa.array([b or None for b in batches], KIND)
    assert wire_format.all_coded(nested).to_pylist() == [wire_format.coded(b) for b in batches]
    assert len(wire_format.all_coded(nested[:0])) == 0


def field(number, value):
    return wire_format._field(number, wire_format.BYTES, value)


@wire
def test_wire_reader_equals_the_runtime_on_damaged_bytes():
    """Cut, changed, repeated and unknown fields; what one refuses the other refuses."""
    rng = random.Random(2)
    values = []
    for _ in range(1500):
        data = bytearray(wire_format.coded(some_resources(rng)))
        for _ in range(rng.randint(0, 2)):
            if data:
                data[rng.randrange(len(data))] = rng.choice([0, 0xFF, rng.randrange(256)])
        values.append(bytes(data[:rng.randint(0, len(data))] if rng.random() < 0.3 else data))
    found = read(values)
    assert 200 < sum(f is not None for f in found) < 1300
    # By their text, as NaN equals nothing.
    assert list(map(repr, found)) == [repr(wire_runtime.batch_row(v)) for v in values]


@wire
def test_wire_reader_merges_and_takes_the_last():
    point_ = lambda v: field(1, b"\x21" + v.to_bytes(8, "little"))
    gauge_, other = field(5, point_(1)), field(7, b"\x08\x01")
    metrics_ = [gauge_ + field(5, point_(2)), gauge_ + other, other + gauge_, gauge_ + other + field(5, point_(3)),
                field(1, b"a") + field(1, b"b"), gauge_ + field(7, b"\x08"), field(2, b"\xff"), field(1, b"\xff"),
                b"\x09" + b"\0" * 8 + gauge_, b"\x2a\x00", b"\x9a\x06\x02hi" + gauge_, b"\x0b\x0c"]
    value_ = [field(1, b"s") + b"\x18\x05", b"\x18\x05" + field(1, b"s"), field(5, b"\x08"), field(7, b"\xff"),
              b"\x10\x02", b"\x18" + b"\xff" * 9 + b"\x01", b"\x18" + b"\xff" * 10 + b"\x01"]
    batches = [field(1, field(2, field(2, m))) for m in metrics_]
    batches += [field(1, field(1, field(1, field(1, b"k") + field(2, v)))) for v in value_]
    batches += [field(1, field(1, b"") + field(1, field(1, field(2, b"\x18\x01")))) + field(1, b"")]
    expected = [wire_runtime.batch_row(b) for b in batches]
    found = read(batches)
    assert found[11] is None  # a group
    del found[11], expected[11]
    assert found == expected and sum(e is None for e in expected) >= 4


def test_shaped_selects_by_name(spark):
    wide = spark.sql("""SELECT array(named_struct(
        'scope_metrics', array(named_struct('scope', 1, 'metrics', array(named_struct(
            'name', 'm', 'unit', 'u', 'gauge', named_struct('data_points', array(named_struct(
                'as_int', CAST(NULL AS bigint), 'as_double', 1.5D, 'time_unix_nano', 7L,
                'attributes', array(named_struct('value', named_struct('string_value', 's',
                    'bool_value', true, 'int_value', 1L, 'double_value', 2D), 'key', 'k'))
            ))))))),
        'resource', CAST(NULL AS struct<attributes:array<struct<key:string,
            value:struct<string_value:string,int_value:bigint,double_value:double,
            bool_value:boolean>>>>))) AS rm""")
    cut = wide.select(otlp.shaped(F.col("rm"), schemas.RESOURCE_METRICS).alias("resource_metrics"))
    (entry,) = cut.collect()[0].resource_metrics
    assert entry.resource is None
    (found,) = entry.scope_metrics[0].metrics[0].gauge.data_points
    assert (found.time_unix_nano, found.as_double, found.attributes[0].key) == (7, 1.5, "k")
