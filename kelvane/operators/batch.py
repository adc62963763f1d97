"""Flattening of nested metric batches into readings.

Everything happens inside one row with array expressions: no shuffle, and no
state when the input is a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.functions import attributes as A
from kelvane.functions.once import computed_once

# Metric names on the wire and the reading column each one fills.
METRIC_COLUMNS = {
    "room.temperature": "temp_c",
    "room.humidity": "humidity",
    "room.pressure": "pressure",
}

NANOS_PER_MS = 1_000_000


def _metrics_with_points(rm: Column) -> Column:
    """Gauges holding a data point, across all scopes, in order."""
    per_scope = F.transform(
        F.coalesce(rm["scope_metrics"], F.array()),
        lambda s: F.coalesce(s["metrics"], F.array()),
    )
    return F.filter(F.flatten(per_scope), lambda m: F.size(m["gauge"]["data_points"]) > 0)


def _value(column: str, found: Column, missing: str) -> Column:
    """Absent metrics read 0.0; ``missing="null"`` keeps humidity and pressure null.

    A point without a double value reads 0.0 either way.
    """
    value = F.coalesce(found["as_double"], F.lit(0.0))
    if missing == "null" and column != "temp_c":
        value = F.when(found.isNotNull(), value)
    return value.alias(column)


def flatten_batches(
    batches: DataFrame,
    mode: str = "first",
    missing: str = "zero",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Readings of ``batches.resource_metrics``, with their ``position``.

    ``mode="first"``: one reading per resource, from data point 0 of each metric.
    ``mode="all"``: one reading per (sensor, room, time) among all data points;
    the time is the ``timestamp_nanos`` attribute where present.
    """
    if mode not in ("first", "all") or missing not in ("zero", "null"):
        raise ValueError(f"unknown mode or missing: {mode!r}, {missing!r}")
    resources = batches.select(
        *keep, F.posexplode_outer("resource_metrics").alias("position", "_rm")
    ).select(
        *keep, "position",
        A.last_text(F.col("_rm")["resource"]["attributes"], "sensor_id").alias("_sensor"),
        A.last_text(F.col("_rm")["resource"]["attributes"], "room").alias("_room"),
        _metrics_with_points(F.col("_rm")).alias("_metrics"),
    )
    found = _first_points(resources, missing, keep) if mode == "first" else \
        _all_points(resources, missing, keep)
    return (
        found.filter((F.col("sensor_id") != "") & F.col("timestamp_ms").isNotNull())
        .withColumn("time", F.timestamp_millis("timestamp_ms"))
    )


def _first_points(resources: DataFrame, missing: str, keep: tuple[str, ...]) -> DataFrame:
    points = resources.withColumn("_points", F.transform("_metrics", lambda m: F.struct(
        m["name"].alias("name"),
        m["gauge"]["data_points"][0]["attributes"].alias("attributes"),
        m["gauge"]["data_points"][0]["as_double"].alias("as_double"),
        F.call_function(
            "div", m["gauge"]["data_points"][0]["time_unix_nano"], F.lit(NANOS_PER_MS)
        ).alias("ms"),
    )))

    def identity(own: str, key: str) -> Column:
        from_points = F.flatten(F.transform("_points", lambda p: A.text_values(
            F.coalesce(p["attributes"], F.array()), key)))
        return F.when(F.col(own) != "", F.col(own)).otherwise(A.first_filled(from_points))

    def last_named(name: str) -> Column:
        return F.try_element_at(F.filter("_points", lambda p: p["name"] == name), F.lit(-1))

    timed = F.filter("_points", lambda p: p["ms"] > 0)
    return computed_once(
        points, [*keep, "position"],
        sensor_id=identity("_sensor", "sensor_id"),
        room=identity("_room", "room"),
        **{column: _value(column, last_named(name), missing)
           for name, column in METRIC_COLUMNS.items()},
        timestamp_ms=F.try_element_at(timed, F.lit(-1))["ms"],
    )


def _all_points(resources: DataFrame, missing: str, keep: tuple[str, ...]) -> DataFrame:
    names = list(METRIC_COLUMNS)

    def identity(own: str, point: Column, key: str) -> Column:
        own_text = F.col(own)
        return F.when(own_text != "", own_text).otherwise(
            A.first_text(point["attributes"], key))

    def point_ms(point: Column) -> Column:
        carried = A.last_int(point["attributes"], "timestamp_nanos")
        return F.call_function(
            "div", F.coalesce(carried, point["time_unix_nano"]), F.lit(NANOS_PER_MS))

    tagged = F.flatten(F.transform("_metrics", lambda m: F.transform(
        m["gauge"]["data_points"], lambda p: F.struct(
            F.when(m["name"].isin(names), m["name"]).otherwise(F.lit("")).alias("name"),
            identity("_sensor", p, "sensor_id").alias("sensor_id"),
            identity("_room", p, "room").alias("room"),
            point_ms(p).alias("ms"),
            p["as_double"].alias("as_double"),
        ))))
    # Sorting brings the points of one reading together, the last of each name
    # being the one that counts. A batch is one message, hence bounded.
    ordered = resources.withColumn("_tagged", tagged).withColumn("_sorted", F.array_sort(
        F.transform("_tagged", lambda p, i: F.struct(
            F.struct(p["sensor_id"], p["room"], p["ms"]).alias("key"),
            p["name"].alias("name"), i.alias("i"), p["as_double"].alias("as_double"),
        ))))

    def following(array: str, i: Column) -> Column:
        return F.get(F.col(array), i + 1)

    def preceding(array: str, i: Column) -> Column:
        return F.get(F.col(array), i - 1)

    last_of_name = ordered.withColumn("_last", F.filter("_sorted", lambda p, i: (
        ~p["key"].eqNullSafe(following("_sorted", i)["key"])
        | (p["name"] != following("_sorted", i)["name"]))))
    # A reading is now a run of at most len(names) + 1 entries.
    span = len(names) + 1
    heads = last_of_name.withColumn("_readings", F.filter(
        F.transform("_last", lambda p, i: F.when(
            ~p["key"].eqNullSafe(preceding("_last", i)["key"]),
            F.struct(
                p["key"].alias("key"),
                F.filter(F.slice(F.col("_last"), i + 1, F.lit(span)),
                         lambda q: q["key"].eqNullSafe(p["key"])).alias("points")))),
        lambda r: r.isNotNull()))

    def named(name: str) -> Column:
        return F.try_element_at(
            F.filter(F.col("_reading")["points"], lambda q: q["name"] == name), F.lit(-1))

    # The outer form infers no filter on the array; empty ones fall to the emit gate.
    one = heads.select(*keep, "position", F.explode_outer("_readings").alias("_reading"))
    key = F.col("_reading")["key"]
    return one.select(
        *keep, "position",
        key["sensor_id"].alias("sensor_id"),
        key["room"].alias("room"),
        *[_value(column, named(name), missing) for name, column in METRIC_COLUMNS.items()],
        F.when(key["ms"] > 0, key["ms"]).alias("timestamp_ms"),
    )
