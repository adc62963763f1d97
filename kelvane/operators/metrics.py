"""Metric rows, latest-value snapshots and assembly of metric batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvane.functions import attributes as A
from kelvane.functions.times import floor_ms, width_ms
from kelvane.operators.payload import nanos

# Metric names with their unit and description.
METRICS = {
    "room.temperature": ("temp_c", "Cel", "Room temperature in degrees Celsius"),
    "room.humidity": ("humidity", "%", "Room relative humidity percentage"),
    "room.pressure": ("pressure", "hPa", "Room atmospheric pressure in hPa"),
}

# Readings of a message: three points each, so that it stays within some hundred kilobytes.
MESSAGE_READINGS = 1000


def metric_rows(readings: DataFrame, ids: tuple[str, ...] = ("sensor_id", "room", "ts_nanos")) -> DataFrame:
    """Wide readings to one row per metric: ids, ``metric``, ``value``."""
    wide = readings
    if "ts_nanos" in ids and "ts_nanos" not in readings.columns:
        wide = readings.withColumn("ts_nanos", nanos(F.unix_millis("time")))
    wide = wide.select(*ids, *[F.col(c).alias(name) for name, (c, _, _) in METRICS.items()])
    return wide.unpivot(list(ids), [f"`{name}`" for name in METRICS], "metric", "value")


def with_units(rows: DataFrame) -> DataFrame:
    """Attach ``unit`` and ``description`` by metric name."""
    def lookup(part: int) -> Column:
        return F.create_map(*[
            F.lit(x) for name, info in METRICS.items() for x in (name, info[part])
        ])[F.col("metric")]
    return rows.withColumn("unit", lookup(1)).withColumn("description", lookup(2))


def latest_snapshot(
    readings: DataFrame,
    arrival: tuple[str, ...] = ("arrival",),
    values: tuple[str, ...] = ("temp_c", "humidity", "pressure", "ts_nanos"),
    keys: tuple[str, ...] = ("sensor_id", "room"),
) -> DataFrame:
    """Values of the reading that arrived last per key, whatever its event time.

    All metrics of a reading arrive together, so they are picked before being
    turned into rows. With a single arrival column the aggregate keeps flat
    buffers (hash aggregation with map-side combine).
    """
    order = F.col(arrival[0]) if len(arrival) == 1 else F.struct(*arrival)
    return readings.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def sampled_snapshot(
    readings: DataFrame,
    period: str = "10 seconds",
    arrival_time: str = "arrival_time",
    arrival: tuple[str, ...] = ("arrival",),
    until: Column | None = None,
    start: Column | None = None,
    chunk: str = "7 days",
) -> DataFrame:
    """The snapshot at every tick: last value of each (sensor, room) seen before it.

    Batch input only. The window below sees one row per key and tick with news
    in a chunk of time, never raw readings; one row per key and chunk tells when
    the next news come. Repeats are generated from those rows without a shuffle,
    from ``start`` on, by default the first news, up to ``until``, by default the
    tick of the last arrival.
    """
    step = width_ms(period)
    ms = F.unix_millis(arrival_time)
    ticked = readings.withColumn("tick_ms", floor_ms(ms, step) + step)
    news = latest_snapshot(ticked, arrival, keys=("sensor_id", "room", "tick_ms"))
    if until is None:
        last = readings.select(F.max(ms).alias("ms")).scalar()
    else:
        last = F.unix_millis(until) - step
    keys = ["sensor_id", "room"]
    news = news.withColumn("_chunk", floor_ms(F.col("tick_ms"), width_ms(chunk)))
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy("tick_ms")
    chunks = news.groupBy(*keys, "_chunk").agg(F.min("tick_ms").alias("_first")).withColumn(
        "_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_chunk")))
    coming = F.coalesce(F.lead("tick_ms").over(in_chunk), "_next") - step
    upto = F.coalesce("_coming", floor_ms(last, step) + step)
    since = F.col("tick_ms")
    if start is not None:
        # The first tick at or behind the start.
        since = F.greatest(since, -floor_ms(-F.unix_millis(start), step))
        upto = F.least(upto, floor_ms(last, step) + step)
    return (
        news.join(chunks.drop("_first"), [*keys, "_chunk"]).withColumn("_coming", coming)
        .withColumns({"_upto": upto, "_since": since})
        .filter(F.col("_upto") >= F.col("_since"))
        .withColumn("tick_ms", F.explode(F.sequence(
            "_since", "_upto", F.lit(step).cast("bigint"))))
        .withColumn("tick", F.timestamp_millis("tick_ms"))
        .drop("_upto", "_since", "_coming", "_next", "_chunk", "tick_ms")
    )


def point_attributes(sensor_id: Column, room: Column, ts_nanos: Column) -> Column:
    """Attributes every data point carries; the event time rides along as one."""
    return F.array(
        A.attribute("sensor_id", text=sensor_id),
        A.attribute("room", text=room),
        A.attribute("timestamp_nanos", number=ts_nanos),
    )


def resource_attributes(service: str = "sensor-service", version: str = "1") -> Column:
    return F.array(
        A.attribute("service.name", text=F.lit(service)),
        A.attribute("service.version", text=F.lit(version)),
    )


def data_point(attrs: Column, time_unix_nano: Column, value: Column) -> Column:
    return F.struct(
        attrs.alias("attributes"),
        time_unix_nano.alias("time_unix_nano"),
        value.alias("as_double"),
        F.lit(None).cast("bigint").alias("as_int"),
    )


def gauge(name: str, points: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), F.struct(points.alias("data_points")).alias("gauge"))


def resource(attrs: Column, metrics: Column) -> Column:
    """One resource entry with a single scope."""
    return F.struct(
        F.struct(attrs.alias("attributes")).alias("resource"),
        F.array(F.struct(metrics.alias("metrics"))).alias("scope_metrics"),
    )


def assemble_batches(snapshots: DataFrame, shards: int = 1, most: int = MESSAGE_READINGS) -> DataFrame:
    """Nested batches per tick: (tick, shard, resource_metrics).

    One message a tick by default, as long as it holds about ``most`` readings
    or fewer. With more ``shards`` each tick is split into up to so many messages
    by a hash of sensor and room, whatever the number of readings; a tick with
    more than ``most`` readings in each of them is split further, so that a
    message stays small however many sensors report.
    """
    # One row per tick, bounded by the calendar and not by the sensors.
    sizes = snapshots.groupBy("tick").agg(F.greatest(
        F.lit(shards).cast("bigint"), F.ceil(F.count(F.lit(1)) / most)).alias("_shards"))
    placed = snapshots.join(F.broadcast(sizes), "tick").withColumn(
        "shard", F.pmod(F.xxhash64("sensor_id", "room"), "_shards"))
    grouped = placed.groupBy("tick", "shard").agg(F.array_sort(F.collect_list(F.struct(
        "sensor_id", "room", "ts_nanos", "temp_c", "humidity", "pressure"))).alias("_items"))
    tick_nanos = F.unix_micros("tick") * 1000

    def points(column: str) -> Column:
        return F.transform("_items", lambda i: data_point(
            point_attributes(i["sensor_id"], i["room"], i["ts_nanos"]), tick_nanos, i[column]))

    metrics = F.array(*[gauge(name, points(c)) for name, (c, _, _) in METRICS.items()])
    return grouped.select("tick", "shard", F.array(
        resource(resource_attributes(), metrics)).alias("resource_metrics"))
