"""Derived inputs: events turned into payloads, metric batches and tables.

A remainder of ``event_id`` decides how a row is bent, so that the SQL
counterparts can state what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane.operators import metrics, payload, windows
from kelvane.sources.events import as_readings, scan_events

HOUR_MS = 3_600_000


def readings(spark: SparkSession, folder: str, start=None, end=None) -> DataFrame:
    return as_readings(scan_events(spark, folder, start, end))


def delayed(rows: DataFrame) -> DataFrame:
    """Every 13th reading arrives an hour after its event time."""
    delay = F.when(F.col("arrival") % 13 == 0, HOUR_MS).otherwise(0)
    return rows.withColumn("arrival_time", F.timestamp_millis(F.unix_millis("time") + delay))


def window_results(spark: SparkSession, folder: str) -> DataFrame:
    return windows.tumble(readings(spark, folder))


def bent_payloads(rows: DataFrame) -> DataFrame:
    """JSON payloads, (arrival, value binary); remainders 0-18 of 97 are bent."""
    plain = payload.encode_payloads(rows, keep=("arrival",))
    text = F.col("value")
    kind = F.col("arrival") % 97

    def swap(old: str, new: str) -> Column:
        return F.replace(text, F.lit(old), F.lit(new))

    bent = {
        0: F.lit("{sensor: ?"),
        1: swap('"schema_version":"1"', '"schema_version":"2"'),
        2: swap('"schema_version":"1"', '"schema_version":1'),
        3: swap('"temp_c"', '"temperature"'),
        4: swap('"temp_c":', '"temp_c":"1.5","t":'),
        5: swap('"timestamp_ms":', '"timestamp_ms":5.0,"t":'),
        6: swap('"timestamp_ms":', '"timestamp_ms":-'),
        7: swap('"', "'"),
        8: swap('"room":', '"room":"x","room":'),
        9: F.concat(F.lit("["), text, F.lit("]")),
        12: F.concat(text, F.lit(" x}")),
        13: swap('"pressure":', '"pressure":NaN,"p":'),
        14: swap('"room":', '"battery_mv":3300,"room":'),
        15: F.concat(F.lit("  \n"), text, F.lit(" \t")),
        16: swap('"pressure":', '"pressure":1e3,"p":'),
        18: swap('"pressure":', '"pressure":1e400,"p":'),
    }
    chosen = F.when(F.lit(False), text)
    for remainder, column in bent.items():
        chosen = chosen.when(kind == remainder, column)
    data = chosen.otherwise(text).cast("binary")
    data = (
        F.when(kind == 10, F.concat(F.unhex(F.lit("C0AF")), text.cast("binary")))
        .when(kind == 11, F.unhex(F.lit("")))
        .when(kind == 17, F.lit(None).cast("binary"))
        .otherwise(data)
    )
    return plain.select("arrival", data.alias("value"))


def bent_batches(rows: DataFrame, per_batch: int = 8) -> DataFrame:
    """Nested batches of eight resources, (batch, resource_metrics).

    Each resource is one reading, in a form chosen by ``arrival % 11``:
    1 ids on the points, 2 no sensor id, 3 zero time, 4 no humidity,
    5 extra unknown metric one second later, 6 temperature twice,
    7 integer-valued pressure, 8 sensor id an integer on the resource and a
    text on the points, 9 empty room, 10 gauge without points in front.
    """
    form = F.col("arrival") % 11
    nano = F.when(form == 3, F.lit(0).cast("bigint")).otherwise(
        F.unix_millis("time") * 1_000_000)
    none = F.array().cast("array<struct<key:string,value:struct<string_value:string,"
                          "int_value:bigint,double_value:double,bool_value:boolean>>>")
    sensor = metrics.A.attribute("sensor_id", text=F.col("sensor_id"))
    room = metrics.A.attribute("room", text=F.col("room"))
    number = metrics.A.attribute("sensor_id", number=F.col("arrival"))
    own = (
        F.when(form.isin(1, 2), none).when(form == 8, F.array(number, room))
        .when(form == 9, F.array(sensor)).otherwise(F.array(sensor, room))
    )
    on_points = F.when(form.isin(1, 8), F.array(sensor, room)).otherwise(none)

    def one(name: str, value: Column, integer: Column | None = None, at: Column = nano) -> Column:
        point = F.struct(
            on_points.alias("attributes"), at.alias("time_unix_nano"), value.alias("as_double"),
            (F.lit(None).cast("bigint") if integer is None else integer).alias("as_int"))
        return metrics.gauge(name, F.array(point))

    nothing = F.lit(None).cast("double")
    temp = one("room.temperature", F.col("temp_c"))
    humid = one("room.humidity", F.col("humidity"))
    press = one("room.pressure", F.col("pressure"))
    pointless = metrics.gauge("room.temperature", F.filter(
        F.array(metrics.data_point(on_points, nano, F.col("temp_c"))), lambda _: F.lit(False)))
    series = (
        F.when(form == 4, F.array(temp, press))
        .when(form == 5, F.array(temp, humid, press, one(
            "room.co2", F.lit(800.0), at=nano + 1_000_000_000)))
        .when(form == 6, F.array(one("room.temperature", F.lit(-1.0)), temp, humid, press))
        .when(form == 7, F.array(temp, humid, one(
            "room.pressure", nothing, F.lit(1000).cast("bigint"))))
        .when(form == 10, F.array(pointless, temp, humid, press))
        .otherwise(F.array(temp, humid, press))
    )
    entries = rows.select(
        F.floor(F.col("arrival") / per_batch).alias("batch"), "arrival",
        metrics.resource(own, series).alias("entry"))
    # Arrival numbers are unique: a batch never holds more than per_batch entries.
    return entries.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("arrival", "entry")), lambda a, b:
                     F.when(a["arrival"] < b["arrival"], -1).otherwise(1)).alias("e")
    ).select("batch", F.transform("e", lambda e: e["entry"]).alias("resource_metrics"))
