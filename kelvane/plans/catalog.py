"""The registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane.functions.numbers import numeric_round
from kelvane.operators import (
    alerts, batch, codec, dashboard, dedup, metrics, payload, quality, rollup, windows,
)
from kelvane.plans import fixtures as fx
from kelvane.plans import sql as q
from kelvane.plans.jobs import JOB_QUERIES
from kelvane.session import tune
from kelvane.sources import otlp

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


def _ms(column: str) -> Column:
    return F.unix_millis(column)


def _rounded_windows(results: DataFrame) -> DataFrame:
    return results.select(
        "room", "bucket_ms", "max_temp", numeric_round(F.col("avg_temp"), 6).alias("avg_temp"),
        "max_humidity", numeric_round(F.col("avg_humidity"), 6).alias("avg_humidity"))


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([q.READINGS, *ctes]) + "\n" + select


# -- windows ---------------------------------------------------------------

def window_5min(spark, folder):
    return _rounded_windows(fx.window_results(spark, folder))


def window_1day(spark, folder):
    return _rounded_windows(windows.tumble(fx.readings(spark, folder), "1 day"))


def window_infinite_guard(spark, folder):
    rows = fx.readings(spark, folder)
    wild = (F.when(F.col("arrival") % 50 == 0, float("inf"))
            .when(F.col("arrival") % 50 == 1, float("-inf")))
    bent = rows.withColumn("temp_c", F.coalesce(wild, F.col("temp_c")))
    return windows.tumble(bent, "1 hour").select("room", "bucket_ms", "max_temp")


def _absent_humidity(missing):
    def run(spark, folder):
        flat = batch.flatten_batches(
            fx.bent_batches(fx.readings(spark, folder)), missing=missing)
        return _rounded_windows(windows.tumble(flat, "1 day"))
    return run


def _late(spark, folder):
    rows = fx.delayed(fx.readings(spark, folder))
    return windows.with_lateness(rows, "arrival_time")


def late_rows(spark, folder):
    return _late(spark, folder).filter("late").select(
        "arrival", "sensor_id", "room", _ms("time").alias("time_ms"))


def window_without_late(spark, folder):
    return _rounded_windows(windows.tumble(_late(spark, folder).filter("NOT late")))


LATE = f"""arrivals AS (
  SELECT *, time_ms + CASE WHEN arrival % 13 = 0 THEN {q.HOUR} ELSE 0 END AS at_ms FROM readings),
tops AS (
  SELECT *, max(time_ms) OVER (ORDER BY at_ms
              RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM arrivals),
judged AS (
  SELECT *, coalesce({q.floor_to('time_ms', q.FIVE_MINUTES)} + {q.FIVE_MINUTES} <= top - 10000,
                     false) AS late FROM tops)"""

FLAT_FIRST = """flat AS (
  SELECT sensor_id, CASE WHEN arrival % 11 = 9 THEN '' ELSE room END AS room, temp_c,
         CASE WHEN arrival % 11 = 4 THEN {absent} ELSE humidity END AS humidity,
         CASE WHEN arrival % 11 = 7 THEN 0 ELSE pressure END AS pressure,
         time_ms + CASE WHEN arrival % 11 = 5 THEN 1000 ELSE 0 END AS time_ms
  FROM readings WHERE arrival % 11 NOT IN (2, 3))"""

WINDOWS = {
    "window_5min": Query(window_5min, _with(
        q.windows(), select=f"SELECT {q.WINDOW_COLUMNS} FROM w")),
    "window_1day": Query(window_1day, _with(
        q.windows(q.DAY), select=f"SELECT {q.WINDOW_COLUMNS} FROM w")),
    "window_infinite_guard": Query(window_infinite_guard, _with(
        """bent AS (SELECT room, time_ms, CASE arrival % 50 WHEN 0 THEN 'inf'::DOUBLE
           WHEN 1 THEN '-inf'::DOUBLE ELSE temp_c END AS temp_c, humidity FROM readings)""",
        f"""w AS (SELECT room, {q.floor_to('time_ms', q.HOUR)} AS bucket_ms, max(temp_c) AS m
           FROM bent GROUP BY 1, 2)""",
        select="SELECT room, bucket_ms, CASE WHEN isinf(m) THEN 0.0 ELSE m END AS max_temp FROM w")),
    "window_absent_as_zero": Query(_absent_humidity("zero"), _with(
        FLAT_FIRST.format(absent="0.0"), q.windows(q.DAY, "flat"),
        select=f"SELECT {q.WINDOW_COLUMNS} FROM w")),
    "window_absent_as_null": Query(_absent_humidity("null"), _with(
        FLAT_FIRST.format(absent="NULL"), q.windows(q.DAY, "flat"),
        select=f"SELECT {q.WINDOW_COLUMNS} FROM w")),
    "late_rows": Query(late_rows, _with(
        LATE, select="SELECT arrival, sensor_id, room, time_ms FROM judged WHERE late")),
    "window_without_late": Query(window_without_late, _with(
        LATE, "kept AS (SELECT * FROM judged WHERE NOT late)", q.windows(source="kept"),
        select=f"SELECT {q.WINDOW_COLUMNS} FROM w")),
}


# -- alerts ----------------------------------------------------------------

def _redelivered(results):
    """Every window whose bucket is a multiple of 35 minutes arrives twice."""
    times = F.when(F.col("bucket_ms") % (7 * q.FIVE_MINUTES) == 0, 2).otherwise(1)
    return results.withColumn("_n", F.explode(F.sequence(F.lit(1), times))).drop("_n")


def _alerts(redeliver=False, **options):
    def run(spark, folder):
        results = fx.window_results(spark, folder)
        return alerts.detect_alerts(_redelivered(results) if redeliver else results, **options)
    return run


def hot_run_lengths(spark, folder):
    return alerts.hot_runs(fx.window_results(spark, folder)).select(
        "room", "bucket_ms", "max_temp", "run_len")


TWICE = (f"v AS (SELECT * FROM w UNION ALL SELECT * FROM w "
         f"WHERE bucket_ms % {7 * q.FIVE_MINUTES} = 0)")

ALERTS = {
    "alerts_runs": Query(_alerts(), _with(q.windows(), q.runs(), select=q.ALERT_ROWS)),
    "alerts_gap_reset": Query(_alerts(gap_resets=True), _with(
        q.windows(), q.runs(gap=True), select=q.ALERT_ROWS)),
    "alerts_redelivered": Query(_alerts(redeliver=True), _with(
        q.windows(), TWICE, q.runs("v"), select=q.ALERT_ROWS)),
    "alerts_redelivered_once": Query(_alerts(redeliver=True, dedupe=True), _with(
        q.windows(), q.runs(), select=q.ALERT_ROWS)),
    "alerts_threshold_40_twice": Query(
        lambda spark, folder: alerts.detect_alerts(
            fx.window_results(spark, folder), threshold=40.0, consecutive=2),
        _with(q.windows(), q.runs(threshold=40.0), select=q.ALERT_ROWS.replace(
            "25.0", "40.0").replace(">= 3", ">= 2"))),
    "hot_run_lengths": Query(hot_run_lengths, _with(
        q.windows(), q.runs(), select="""SELECT room, bucket_ms, max_temp,
        CASE WHEN max_temp > 25.0 THEN run_len ELSE 0 END AS run_len FROM runs""")),
}


# -- rollup and dashboard --------------------------------------------------

START = datetime(2024, 1, 10, 6, tzinfo=timezone.utc)
END = datetime(2024, 1, 20, 18, tzinfo=timezone.utc)
START_MS, END_MS = (int(t.timestamp() * 1000) for t in (START, END))
ROOMS = ["click", "view"]


def _aggregated(spark, folder):
    return windows.as_table_rows(fx.window_results(spark, folder))


def _stored_alerts(spark, folder):
    """Alerts as stored, written five minutes after their window starts."""
    raised = alerts.detect_alerts(fx.window_results(spark, folder))
    return raised.select(
        F.timestamp_millis(F.col("window_start_ms") + q.FIVE_MINUTES).alias("time"), "room",
        "max_temp", "consecutive_count",
        F.timestamp_millis("window_start_ms").alias("window_start"))


def hourly_rollup(spark, folder):
    return rollup.hourly(fx.readings(spark, folder)).select(
        _ms("bucket").alias("bucket_ms"), "room", "min_temp", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"))


def latest_per_room(spark, folder):
    return dashboard.latest_per_room(fx.readings(spark, folder)).select(
        _ms("time").alias("time_ms"), "room", "temp_c")


def temp_band(spark, folder):
    return fx.readings(spark, folder).groupBy(
        dashboard.band(F.col("temp_c")).alias("band")).agg(F.count("*").alias("n"))


def latest_banded(spark, folder):
    return latest_per_room(spark, folder).select(
        "room", "temp_c", dashboard.band(F.col("temp_c")).alias("band"))


def _series(frame):
    return frame.select(_ms("time").alias("time_ms"), "metric", "value")


def series_1min(spark, folder):
    return _series(dashboard.series_by_minute(fx.readings(spark, folder)))


def series_1min_filtered(spark, folder):
    rows = fx.readings(spark, folder, START, END)
    return _series(dashboard.series_by_minute(rows, ROOMS, START, END))


def series_5min_labelled(spark, folder):
    return _series(dashboard.series_of_windows(_aggregated(spark, folder)))


def series_hourly(spark, folder):
    # Whole hours: the last bucket may start at the end of the range.
    rows = fx.readings(spark, folder, START, END + timedelta(hours=1))
    return _series(dashboard.series_by_hour(rollup.hourly(rows), ROOMS, START, END))


def series_extreme_values(spark, folder):
    """The 1-minute series with a temperature of up to 1e300 in every 50th reading."""
    wild = F.when(F.col("arrival") % 50 == 0, F.lit(1e300) / (1 + F.col("arrival") % 7)).otherwise(
        F.when(F.col("arrival") % 50 == 1, F.lit(-1e23)).otherwise(F.col("temp_c")))
    rows = fx.readings(spark, folder).withColumn("temp_c", wild)
    return _series(dashboard.series_by_minute(rows))


def series_pivot(spark, folder):
    stored = rollup.hourly(fx.readings(spark, folder))
    rooms = ["click", "error", "purchase", "signup", "view"]
    wide = dashboard.one_column_per_metric(dashboard.series_by_hour(stored), rooms)
    return wide.select(_ms("time").alias("time_ms"), *rooms)


def alert_log(spark, folder):
    return dashboard.alert_log(_stored_alerts(spark, folder), START, END).select(
        _ms("time").alias("time_ms"), "room", "max_temp", "consecutive_count",
        _ms("window_start").alias("window_start_ms"))


def recent_readings(spark, folder):
    return dashboard.most_recent(
        fx.readings(spark, folder), "time", 10, ("sensor_id", "arrival")).select(
        _ms("time").alias("time_ms"), "sensor_id", "room", "temp_c", "humidity", "pressure")


def recent_buckets(spark, folder):
    return dashboard.most_recent(_aggregated(spark, folder), "bucket", 12, ("room",)).select(
        _ms("bucket").alias("bucket_ms"), "room", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"))


HOURS = f"""h AS (SELECT {q.floor_to('time_ms', q.HOUR)} AS bucket_ms, room,
  min(temp_c) AS min_temp, max(temp_c) AS max_temp, avg(temp_c) AS avg_temp
  FROM readings GROUP BY 1, 2)"""
IN_ROOMS = "room IN ('click', 'view')"
BANDS = ("CASE WHEN {0} >= 27 THEN 'red' WHEN {0} >= 24 THEN 'yellow' "
         "WHEN {0} >= 18 THEN 'green' ELSE 'blue' END")
NEWEST = f"""newest AS (SELECT time_ms, room, {q.num('temp_c', 1)} AS temp_c FROM (
  SELECT *, row_number() OVER (PARTITION BY room ORDER BY time_ms DESC, sensor_id, arrival) AS rn
  FROM readings) WHERE rn = 1)"""


def _minute_series(where: str) -> str:
    return _with(select=f"""SELECT {q.floor_to('time_ms', 60000)} AS time_ms, room AS metric,
      {q.num('avg(temp_c)', 2)} AS value FROM readings WHERE {where} GROUP BY 1, 2""")


DASHBOARD = {
    "hourly_rollup": Query(hourly_rollup, _with(HOURS, select=f"""
        SELECT bucket_ms, room, min_temp, max_temp, {q.num('avg_temp', 6)} AS avg_temp FROM h""")),
    "latest_per_room": Query(latest_per_room, _with(NEWEST, select="SELECT * FROM newest")),
    "temp_band": Query(temp_band, _with(select=f"""
        SELECT {BANDS.format('temp_c')} AS band, count(*) AS n FROM readings GROUP BY 1""")),
    "latest_banded": Query(latest_banded, _with(NEWEST, select=f"""
        SELECT room, temp_c, {BANDS.format('temp_c')} AS band FROM newest""")),
    "room_list": Query(
        lambda spark, folder: dashboard.room_list(fx.readings(spark, folder)),
        _with(select="SELECT DISTINCT room FROM readings")),
    "distinct_sensors": Query(
        lambda spark, folder: dashboard.sensor_list(fx.readings(spark, folder)),
        _with(select="SELECT DISTINCT sensor_id FROM readings")),
    "aggregated_rooms": Query(
        lambda spark, folder: dashboard.room_list(_aggregated(spark, folder)),
        _with(q.windows(), select="SELECT DISTINCT room FROM w")),
    "series_1min": Query(series_1min, _minute_series("true")),
    "series_1min_filtered": Query(series_1min_filtered, _minute_series(
        f"{IN_ROOMS} AND time_ms BETWEEN {START_MS} AND {END_MS}")),
    "series_5min_labelled": Query(series_5min_labelled, _with(q.windows(), select=f"""
        SELECT bucket_ms AS time_ms, room || ' avg' AS metric, {q.num('avg_temp', 2)} AS value
        FROM w UNION ALL SELECT bucket_ms, room || ' max', {q.num('max_temp', 2)} FROM w""")),
    "series_extreme_values": Query(series_extreme_values, _with("""bent AS (
        SELECT time_ms, room, CASE arrival % 50 WHEN 0 THEN 1e300 / (1 + arrival % 7)
        WHEN 1 THEN -1e23 ELSE temp_c END AS temp_c FROM readings)""", f"""means AS (
        SELECT {q.floor_to('time_ms', 60000)} AS time_ms, room, avg(temp_c) AS mean FROM bent GROUP BY 1, 2)""",
        select=f"""SELECT time_ms, room AS metric, CASE WHEN abs(mean) >= 1e20 THEN mean
        ELSE {q.num('CASE WHEN abs(mean) >= 1e20 THEN 0.0 ELSE mean END', 2)} END AS value FROM means""")),
    "series_hourly": Query(series_hourly, _with(HOURS, select=f"""
        SELECT bucket_ms AS time_ms, room AS metric, {q.num('avg_temp', 2)} AS value FROM h
        WHERE {IN_ROOMS} AND bucket_ms BETWEEN {START_MS} AND {END_MS}""")),
    "series_pivot": Query(series_pivot, _with(HOURS, select=f"""
        SELECT bucket_ms AS time_ms, {', '.join(
            f"max({q.num('avg_temp', 2)}) FILTER (WHERE room = '{r}') AS {r}"
            for r in ('click', 'error', 'purchase', 'signup', 'view'))}
        FROM h GROUP BY 1""")),
    "alert_log": Query(alert_log, _with(q.windows(), q.runs(), f"""raised AS ({q.ALERT_ROWS})""",
        select=f"""SELECT window_start_ms + {q.FIVE_MINUTES} AS time_ms, room,
        {q.num('max_temp', 1)} AS max_temp, consecutive_count, window_start_ms FROM raised
        WHERE window_start_ms + {q.FIVE_MINUTES} BETWEEN {START_MS} AND {END_MS}
        ORDER BY time_ms DESC, room, window_start_ms LIMIT 100""")),
    "alert_listing": Query(
        lambda spark, folder: _stored_alerts(spark, folder).select(
            _ms("time").alias("time_ms"), "room", "max_temp", "consecutive_count",
            _ms("window_start").alias("window_start_ms")),
        _with(q.windows(), q.runs(), f"raised AS ({q.ALERT_ROWS})", select=f"""
        SELECT window_start_ms + {q.FIVE_MINUTES} AS time_ms, room, max_temp, consecutive_count,
        window_start_ms FROM raised""")),
    "recent_readings": Query(recent_readings, _with(select="""
        SELECT time_ms, sensor_id, room, temp_c, humidity, pressure FROM readings
        ORDER BY time_ms DESC, sensor_id, arrival LIMIT 10""")),
    "recent_buckets": Query(recent_buckets, _with(q.windows(), select=f"""
        SELECT bucket_ms, room, max_temp, {q.num('avg_temp', 6)} AS avg_temp FROM w
        ORDER BY bucket_ms DESC, room LIMIT 12""")),
    "count_readings": Query(
        lambda spark, folder: dashboard.row_count(fx.readings(spark, folder)),
        _with(select="SELECT count(*) AS n FROM readings")),
}


# -- payloads, metric rows, snapshots --------------------------------------

def _parsed(spark, folder):
    return payload.parse_payloads(fx.bent_payloads(fx.readings(spark, folder)))


def payload_decode(spark, folder):
    return payload.accepted(_parsed(spark, folder), keep=("arrival",)).select(
        "arrival", "schema_version", "sensor_id", "room", "temp_c", "humidity", "pressure",
        "timestamp_ms", "ts_nanos")


def payload_rejects(spark, folder):
    return payload.rejected(_parsed(spark, folder), keep=("arrival",)).select(
        "arrival", "reject_reason")


def metrics_long(spark, folder):
    return metrics.with_units(metrics.metric_rows(fx.readings(spark, folder)))


def snapshot_latest(spark, folder):
    rows = fx.readings(spark, folder).withColumn(
        "ts_nanos", payload.nanos(F.unix_millis("time")))
    return metrics.metric_rows(metrics.latest_snapshot(rows))


def _sampled(spark, folder, period="1 day"):
    rows = fx.readings(spark, folder).withColumn(
        "ts_nanos", payload.nanos(F.unix_millis("time")))
    return metrics.sampled_snapshot(rows, period, arrival_time="time")


def snapshot_sampled(spark, folder):
    return _sampled(spark, folder, "6 hours").select(
        _ms("tick").alias("tick_ms"), "sensor_id", "room", "temp_c", "humidity", "pressure",
        "ts_nanos")


def snapshot_sampled_range(spark, folder):
    """Ticks of ten days out of the middle, from a start between two ticks."""
    rows = fx.readings(spark, folder).withColumn(
        "ts_nanos", payload.nanos(F.unix_millis("time")))
    found = metrics.sampled_snapshot(rows, "6 hours", arrival_time="time", start=F.lit(RANGE_START),
                                     until=F.lit(END))
    return found.select(_ms("tick").alias("tick_ms"), "sensor_id", "room", "temp_c", "humidity",
                        "pressure", "ts_nanos")


RANGE_START = START + timedelta(hours=1)


def batch_assembled(spark, folder):
    """Per tick, what its batches hold: points and attributes in total."""
    nested = metrics.assemble_batches(_sampled(spark, folder), shards=3)
    found = F.flatten(F.flatten(F.transform("resource_metrics", lambda r: F.transform(
        F.flatten(F.transform(r["scope_metrics"], lambda s: s["metrics"])),
        lambda m: m["gauge"]["data_points"]))))
    return nested.select("tick", F.size(found).alias("points"), F.aggregate(
        found, F.lit(0), lambda n, p: n + F.size(p["attributes"])).alias("attributes")).groupBy(
        _ms("tick").alias("tick_ms")).agg(
        F.sum("points").alias("points"), F.sum("attributes").alias("attributes"))


def batch_roundtrip(spark, folder):
    nested = metrics.assemble_batches(_sampled(spark, folder), shards=3)
    return batch.flatten_batches(nested, "all", keep=("tick",)).select(
        _ms("tick").alias("tick_ms"), "sensor_id", "room", "temp_c", "humidity", "pressure",
        (F.col("timestamp_ms") * 1_000_000).alias("ts_nanos"))


def _flat(mode):
    def run(spark, folder):
        nested = fx.bent_batches(fx.readings(spark, folder))
        return batch.flatten_batches(nested, mode).select(
            "sensor_id", "room", "temp_c", "humidity", "pressure", "timestamp_ms")
    return run


def batch_wire_decode(spark, folder):
    """Batches as bytes, a quarter of them cut or emptied, and back."""
    coded = otlp.encode_batches(fx.bent_batches(fx.readings(spark, folder)))
    form = F.col("batch") % 12
    value = F.col("value")
    cut = (F.when(form == 0, F.unhex(F.lit("0AFF037F4B2201")))
           .when(form == 1, F.unhex(F.lit("")))
           .when(form == 2, F.lit(None).cast("binary"))
           .otherwise(value))
    nested = otlp.decode_batches(coded.withColumn("value", cut), native=False)
    return batch.flatten_batches(nested).select(
        "sensor_id", "room", "temp_c", "humidity", "pressure", "timestamp_ms")


def window_json_roundtrip(spark, folder):
    messages = codec.window_messages(fx.window_results(spark, folder))
    return _rounded_windows(codec.read_messages(messages))


def alert_json_roundtrip(spark, folder):
    raised = alerts.detect_alerts(fx.window_results(spark, folder))
    messages = codec.alert_messages(raised).withColumn("routed_to", F.col("key").cast("string"))
    return codec.read_messages(messages, codec.schemas.ALERT, keep=("routed_to",))


def first_wins_dedup(spark, folder):
    """Readings of one sensor and minute collapse to the first that arrived."""
    rows = fx.readings(spark, folder).withColumn("time", F.date_trunc("minute", "time"))
    copies = F.array(F.col("arrival"), F.col("arrival") + 10_000_000_000)
    doubled = rows.withColumn("arrival", F.explode(copies))
    return dedup.first_wins(doubled, ["sensor_id", "time"], ["arrival"]).select(
        _ms("time").alias("time_ms"), "sensor_id", "room", "temp_c", "humidity", "pressure",
        "arrival")


REASONS = """CASE arrival % 97
  WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'unsupported_version' WHEN 2 THEN 'type:schema_version'
  WHEN 3 THEN 'missing:temp_c' WHEN 4 THEN 'type:temp_c' WHEN 5 THEN 'type:timestamp_ms'
  WHEN 6 THEN 'type:timestamp_ms' WHEN 7 THEN 'malformed_json' WHEN 8 THEN 'malformed_json'
  WHEN 9 THEN 'not_an_object' WHEN 10 THEN 'invalid_utf8' WHEN 11 THEN 'empty'
  WHEN 12 THEN 'malformed_json' WHEN 13 THEN 'malformed_json' WHEN 17 THEN 'empty'
  WHEN 18 THEN 'type:pressure' END"""
FLAT_COLUMNS = "sensor_id, room, temp_c, humidity, pressure, time_ms AS timestamp_ms"
# All points: an unknown metric has its own time, hence its own reading of zeros,
# and the two temperatures of form 6 share a reading, the later one winning.
FLAT_ALL = """flat AS (
  SELECT sensor_id, CASE WHEN arrival % 11 = 9 THEN '' ELSE room END AS room, temp_c,
         CASE WHEN arrival % 11 = 4 THEN 0 ELSE humidity END AS humidity,
         CASE WHEN arrival % 11 = 7 THEN 0 ELSE pressure END AS pressure, time_ms
  FROM readings WHERE arrival % 11 NOT IN (2, 3)
  UNION ALL
  SELECT sensor_id, room, 0.0, 0.0, 0.0, time_ms + 1000 FROM readings WHERE arrival % 11 = 5)"""
SNAP_COLUMNS = "tick_ms, sensor_id, room, temp_c, humidity, pressure, ts_nanos"

DECODE = {
    "payload_decode": Query(payload_decode, _with(
        f"judged AS (SELECT *, {REASONS} AS reason FROM readings)", select="""
        SELECT arrival, '1' AS schema_version, sensor_id, room, temp_c, humidity,
        CASE WHEN arrival % 97 = 16 THEN 1000 ELSE pressure END AS pressure,
        time_ms AS timestamp_ms, time_ms * 1000000 AS ts_nanos FROM judged
        WHERE reason IS NULL""")),
    "payload_rejects": Query(payload_rejects, _with(
        f"judged AS (SELECT *, {REASONS} AS reason FROM readings)",
        select="SELECT arrival, reason AS reject_reason FROM judged WHERE reason IS NOT NULL")),
    "metrics_long": Query(metrics_long, _with(select="""
        SELECT sensor_id, room, time_ms * 1000000 AS ts_nanos, m.metric, CASE m.metric
          WHEN 'room.temperature' THEN temp_c WHEN 'room.humidity' THEN humidity
          ELSE pressure END AS value, m.unit, m.description
        FROM readings CROSS JOIN (VALUES
          ('room.temperature', 'Cel', 'Room temperature in degrees Celsius'),
          ('room.humidity', '%', 'Room relative humidity percentage'),
          ('room.pressure', 'hPa', 'Room atmospheric pressure in hPa'))
          AS m(metric, unit, description)""")),
    "snapshot_latest": Query(snapshot_latest, _with("""last AS (
        SELECT sensor_id, room, arg_max(temp_c, arrival) AS t, arg_max(humidity, arrival) AS h,
        arg_max(pressure, arrival) AS p, arg_max(time_ms, arrival) * 1000000 AS ts_nanos
        FROM readings GROUP BY 1, 2)""", select="""
        SELECT sensor_id, room, ts_nanos, 'room.temperature' AS metric, t AS value FROM last
        UNION ALL SELECT sensor_id, room, ts_nanos, 'room.humidity', h FROM last
        UNION ALL SELECT sensor_id, room, ts_nanos, 'room.pressure', p FROM last""")),
    "snapshot_sampled": Query(snapshot_sampled, _with(
        q.snapshots(6 * q.HOUR), select=f"SELECT {SNAP_COLUMNS} FROM snaps")),
    "snapshot_sampled_range": Query(snapshot_sampled_range, _with(
        q.snapshots(6 * q.HOUR), select=f"""SELECT {SNAP_COLUMNS} FROM snaps
        WHERE tick_ms BETWEEN {START_MS + q.HOUR} AND {END_MS}""")),
    "batch_assembled": Query(batch_assembled, _with(
        q.snapshots(q.DAY), select="""SELECT tick_ms, count(*) * 3 AS points,
        count(*) * 9 AS attributes FROM snaps GROUP BY 1""")),
    "batch_roundtrip": Query(batch_roundtrip, _with(
        q.snapshots(q.DAY), select=f"SELECT {SNAP_COLUMNS} FROM snaps")),
    "batch_flatten_first": Query(_flat("first"), _with(
        FLAT_FIRST.format(absent="0.0"), select=f"SELECT {FLAT_COLUMNS} FROM flat")),
    "batch_flatten_all": Query(_flat("all"), _with(
        FLAT_ALL, select=f"SELECT {FLAT_COLUMNS} FROM flat")),
    "window_json_roundtrip": Query(window_json_roundtrip, _with(
        q.windows(), select=f"SELECT {q.WINDOW_COLUMNS} FROM w")),
    "alert_json_roundtrip": Query(alert_json_roundtrip, _with(
        q.windows(), q.runs(), f"raised AS ({q.ALERT_ROWS})",
        select="SELECT room AS routed_to, * FROM raised")),
    "first_wins_dedup": Query(first_wins_dedup, _with("""ranked AS (
        SELECT *, row_number() OVER (PARTITION BY sensor_id, time_ms - time_ms % 60000
          ORDER BY arrival) AS rn FROM readings)""", select="""
        SELECT time_ms - time_ms % 60000 AS time_ms, sensor_id, room, temp_c, humidity, pressure,
        arrival FROM ranked WHERE rn = 1""")),
}
DECODE["batch_wire_decode"] = Query(batch_wire_decode, _with(
    "sound AS (SELECT * FROM readings WHERE (arrival // 8) % 12 > 2)",
    FLAT_FIRST.format(absent="0.0").replace("FROM readings", "FROM sound"),
    select=f"SELECT {FLAT_COLUMNS} FROM flat"))


# -- data quality ----------------------------------------------------------

def _messages(spark, folder):
    return fx.bent_payloads(fx.readings(spark, folder))


def v1_field_mismatches(spark, folder):
    found = quality.field_mismatches(_messages(spark, folder), keep=("arrival",))
    return found.select("arrival", F.array_join("missing", ",").alias("missing"),
                        F.array_join("unexpected", ",").alias("unexpected"))


def v4_sensors_in_many_rooms(spark, folder):
    return quality.sensors_in_many_rooms(fx.readings(spark, folder))


def v4_repeated_ids(spark, folder):
    registry = fx.readings(spark, folder).select("sensor_id", "room").distinct()
    return quality.repeated_ids(registry)


def v5_far_from_arrival(spark, folder):
    return quality.far_from_arrival(fx.delayed(fx.readings(spark, folder))).select(
        "arrival", "sensor_id", "gap_ms")


def v6_cadence(spark, folder):
    return quality.cadence(fx.readings(spark, folder)).withColumn(
        "mean_gap_ms", numeric_round(F.col("mean_gap_ms"), 3))


def v7_misaligned_buckets(spark, folder):
    """Every tenth bucket is pushed off its boundary."""
    results = fx.window_results(spark, folder)
    moved = F.when(F.col("bucket_ms") % (10 * q.FIVE_MINUTES) == 0, 1).otherwise(0)
    return quality.misaligned_buckets(
        results.withColumn("bucket_ms", F.col("bucket_ms") + moved)).select("room", "bucket_ms")


def v8_absent_sensors(spark, folder):
    """Customers expected as sensors of which no reading came."""
    expected = spark.read.schema("c_custkey bigint").parquet(f"{folder}/customer.parquet").select(
        F.concat(F.lit("sensor-"), F.col("c_custkey").cast("string")).alias("sensor_id"))
    return quality.absent(expected, fx.readings(spark, folder), ["sensor_id"])


def v9_repeated_keys(spark, folder):
    minute = fx.readings(spark, folder).withColumn("time", F.date_trunc("hour", "time"))
    return quality.repeated_keys(minute, ["sensor_id", "time"]).select(
        "sensor_id", _ms("time").alias("time_ms"), "n")


def v10_implausible_windows(spark, folder):
    return quality.implausible_windows(windows.tumble(
        fx.readings(spark, folder), "1 hour")).select("room", "bucket_ms", "max_temp")


def v11_alert_summary(spark, folder):
    return quality.alert_summary(alerts.detect_alerts(fx.window_results(spark, folder)))


def v12_stuck_sensors(spark, folder):
    """Temperatures in steps of 40, so that repeats occur."""
    coarse = fx.readings(spark, folder).withColumn(
        "temp_c", F.floor(F.col("temp_c") / 40) * 40.0)
    return quality.stuck_sensors(coarse, "1 day", 3)


def v13_rows_per_day(spark, folder):
    return quality.rows_per_day(fx.readings(spark, folder)).select(
        F.datediff("day", F.lit("1970-01-01").cast("date")).cast("bigint").alias("day"), "n")


ALL_FIELDS = "humidity,pressure,room,schema_version,sensor_id,temp_c,timestamp_ms"
QUALITY = {
    "v1_field_mismatches": Query(v1_field_mismatches, _with(f"""judged AS (
        SELECT arrival, CASE WHEN arrival % 97 IN (0, 7, 8, 9, 10, 11, 12, 13, 17)
          THEN '{ALL_FIELDS}' WHEN arrival % 97 = 3 THEN 'temp_c' ELSE '' END AS missing,
        CASE arrival % 97 WHEN 3 THEN 'temperature' WHEN 4 THEN 't' WHEN 5 THEN 't'
          WHEN 14 THEN 'battery_mv' WHEN 16 THEN 'p' WHEN 18 THEN 'p' ELSE '' END AS unexpected
        FROM readings)""",
        select="SELECT * FROM judged WHERE missing <> '' OR unexpected <> ''")),
    "v2_type_mismatches": Query(
        lambda spark, folder: quality.type_mismatches(_messages(spark, folder), keep=("arrival",)),
        _with("""judged AS (SELECT arrival,
          CASE arrival % 97 WHEN 2 THEN 'BIGINT' WHEN 9 THEN 'ABSENT' ELSE 'STRING' END
            AS version_type,
          CASE arrival % 97 WHEN 1 THEN '2' WHEN 9 THEN NULL ELSE '1' END AS version,
          CASE arrival % 97 WHEN 5 THEN 'DECIMAL' WHEN 9 THEN 'ABSENT' ELSE 'BIGINT' END
            AS time_type FROM readings)""",
              select="SELECT * FROM judged WHERE arrival % 97 IN (1, 2, 5, 9)")),
    "v3_out_of_range": Query(
        lambda spark, folder: quality.out_of_range(fx.readings(spark, folder)),
        _with(select="""SELECT sensor_id,
          count(*) FILTER (WHERE temp_c NOT BETWEEN 15 AND 30) AS temp_c_bad,
          count(*) FILTER (WHERE humidity NOT BETWEEN 0 AND 100) AS humidity_bad
          FROM readings GROUP BY 1 HAVING temp_c_bad + humidity_bad > 0""")),
    "v4_sensors_in_many_rooms": Query(v4_sensors_in_many_rooms, _with(select="""
        SELECT sensor_id, count(DISTINCT room) AS rooms FROM readings GROUP BY 1
        HAVING rooms > 1""")),
    "v4_repeated_ids": Query(v4_repeated_ids, _with(select="""
        SELECT sensor_id, count(DISTINCT room) AS n FROM readings GROUP BY 1 HAVING n > 1""")),
    "v5_far_from_arrival": Query(v5_far_from_arrival, _with(select=f"""
        SELECT arrival, sensor_id, CAST({q.HOUR} AS BIGINT) AS gap_ms FROM readings
        WHERE arrival % 13 = 0""")),
    "v6_cadence": Query(v6_cadence, _with("""gaps AS (
        SELECT sensor_id, time_ms - lag(time_ms) OVER (PARTITION BY sensor_id ORDER BY time_ms)
          AS gap FROM readings)""", select=f"""
        SELECT sensor_id, count(*) AS readings, min(gap) AS min_gap_ms, max(gap) AS max_gap_ms,
        {q.num('CAST(sum(gap) AS DOUBLE) / count(gap)', 3)} AS mean_gap_ms
        FROM gaps GROUP BY 1 HAVING count(*) > 1""")),
    "v7_misaligned_buckets": Query(v7_misaligned_buckets, _with(q.windows(), select=f"""
        SELECT room, bucket_ms + 1 AS bucket_ms FROM w
        WHERE bucket_ms % {10 * q.FIVE_MINUTES} = 0""")),
    "v8_absent_sensors": Query(v8_absent_sensors, _with(select="""
        SELECT 'sensor-' || c_custkey AS sensor_id FROM customer
        WHERE 'sensor-' || c_custkey NOT IN (SELECT sensor_id FROM readings)""")),
    "v9_repeated_keys": Query(v9_repeated_keys, _with(select=f"""
        SELECT sensor_id, {q.floor_to('time_ms', q.HOUR)} AS time_ms, count(*) AS n FROM readings
        GROUP BY 1, 2 HAVING n > 1""")),
    "v10_implausible_windows": Query(v10_implausible_windows, _with(q.windows(q.HOUR), select="""
        SELECT room, bucket_ms, max_temp FROM w
        WHERE max_temp NOT BETWEEN 18 AND 26 OR avg_temp NOT BETWEEN 18 AND 26""")),
    "v11_alert_summary": Query(v11_alert_summary, _with(
        q.windows(), q.runs(), f"raised AS ({q.ALERT_ROWS})",
        select="SELECT count(*) AS alerts, CAST(0 AS BIGINT) AS incomplete FROM raised")),
    "v12_stuck_sensors": Query(v12_stuck_sensors, _with(f"""days AS (
        SELECT sensor_id, {q.floor_to('time_ms', q.DAY)} AS bucket_ms, count(*) AS n,
        min(floor(temp_c / 40) * 40.0) AS temp_c, max(floor(temp_c / 40) * 40.0) AS high
        FROM readings GROUP BY 1, 2)""", select="""
        SELECT sensor_id, bucket_ms, n, temp_c FROM days WHERE n >= 3 AND temp_c = high""")),
    "v13_rows_per_day": Query(v13_rows_per_day, _with(select=f"""
        SELECT time_ms // {q.DAY} AS day, count(*) AS n FROM readings GROUP BY 1""")),
}


QUERIES: dict[str, Query] = {
    **WINDOWS, **ALERTS, **DASHBOARD, **DECODE, **QUALITY,
    **{name: Query(*pair) for name, pair in JOB_QUERIES.items()},
}


def runner(name: str) -> Run:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return QUERIES[name].run(tune(spark), folder)
    return run
