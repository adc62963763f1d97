"""Declared schemas. Nothing in the library is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


PAYLOAD = _struct(
    ("schema_version", T.StringType(), False),
    ("sensor_id", T.StringType(), False),
    ("room", T.StringType(), False),
    ("temp_c", T.DoubleType(), False),
    ("humidity", T.DoubleType(), False),
    ("pressure", T.DoubleType(), False),
    ("timestamp_ms", T.LongType(), False),
)

ANY_VALUE = _struct(
    ("string_value", T.StringType(), True),
    ("int_value", T.LongType(), True),
    ("double_value", T.DoubleType(), True),
    ("bool_value", T.BooleanType(), True),
)

ATTRIBUTES = T.ArrayType(_struct(("key", T.StringType(), True), ("value", ANY_VALUE, True)))

DATA_POINT = _struct(
    ("attributes", ATTRIBUTES, True),
    ("time_unix_nano", T.LongType(), True),
    ("as_double", T.DoubleType(), True),
    ("as_int", T.LongType(), True),
)

METRIC = _struct(
    ("name", T.StringType(), True),
    ("gauge", _struct(("data_points", T.ArrayType(DATA_POINT), True)), True),
)

RESOURCE_METRICS = T.ArrayType(_struct(
    ("resource", _struct(("attributes", ATTRIBUTES, True)), True),
    ("scope_metrics", T.ArrayType(_struct(("metrics", T.ArrayType(METRIC), True))), True),
))

OTLP_BATCH = _struct(("resource_metrics", RESOURCE_METRICS, True))

# Rows as they come off a topic; file-backed topics use the same columns.
TOPIC = _struct(
    ("key", T.BinaryType(), True),
    ("value", T.BinaryType(), True),
    ("partition", T.IntegerType(), True),
    ("offset", T.LongType(), True),
)

READINGS_RAW = _struct(
    ("time", T.TimestampType(), False),
    ("sensor_id", T.StringType(), False),
    ("room", T.StringType(), False),
    ("temp_c", T.DoubleType(), False),
    ("humidity", T.DoubleType(), True),
    ("pressure", T.DoubleType(), True),
    ("event_date", T.DateType(), False),
)

READINGS_AGGREGATED = _struct(
    ("bucket", T.TimestampType(), False),
    ("room", T.StringType(), False),
    ("max_temp", T.DoubleType(), False),
    ("avg_temp", T.DoubleType(), False),
    ("max_humidity", T.DoubleType(), True),
    ("avg_humidity", T.DoubleType(), True),
    ("event_date", T.DateType(), False),
)

ALERTS = _struct(
    ("id", T.LongType(), False),
    ("room", T.StringType(), False),
    ("window_start", T.TimestampType(), False),
    ("max_temp", T.DoubleType(), False),
    ("consecutive_count", T.IntegerType(), False),
    ("time", T.TimestampType(), False),
    ("event_date", T.DateType(), False),
)

HOURLY_TEMP = _struct(
    ("bucket", T.TimestampType(), False),
    ("room", T.StringType(), False),
    ("min_temp", T.DoubleType(), True),
    ("max_temp", T.DoubleType(), True),
    ("avg_temp", T.DoubleType(), True),
    ("event_date", T.DateType(), False),
)

# Hours of rooms whose readings changed since they were rolled up.
HOURLY_STALE = _struct(
    ("bucket", T.TimestampType(), False),
    ("room", T.StringType(), False),
)

# What one commit adds to a five-minute window; such rows merge by sums and extremes.
WINDOW_PARTIALS = _struct(
    ("bucket", T.TimestampType(), False),
    ("room", T.StringType(), False),
    ("n_temp", T.LongType(), False),
    ("sum_temp", T.DoubleType(), True),
    ("min_temp", T.DoubleType(), True),
    ("max_temp", T.DoubleType(), True),
    ("n_humidity", T.LongType(), False),
    ("sum_humidity", T.DoubleType(), True),
    ("max_humidity", T.DoubleType(), True),
    ("commit", T.StringType(), True),
    ("event_date", T.DateType(), False),
)

# In-flight form of a closed window, and of an alert, between jobs.
WINDOW_RESULT = _struct(
    ("room", T.StringType(), False),
    ("bucket_ms", T.LongType(), False),
    ("max_temp", T.DoubleType(), False),
    ("avg_temp", T.DoubleType(), False),
    ("max_humidity", T.DoubleType(), True),
    ("avg_humidity", T.DoubleType(), True),
)

ALERT = _struct(
    ("room", T.StringType(), False),
    ("window_start_ms", T.LongType(), False),
    ("max_temp", T.DoubleType(), False),
    ("consecutive_count", T.IntegerType(), False),
)

TABLES = {
    "readings_raw": (READINGS_RAW, "event_date"),
    "readings_aggregated": (READINGS_AGGREGATED, "event_date"),
    "hourly_temp": (HOURLY_TEMP, "event_date"),
    "alerts": (ALERTS, "event_date"),
    "hourly_stale": (HOURLY_STALE, None),
    "window_partials": (WINDOW_PARTIALS, "event_date"),
}
