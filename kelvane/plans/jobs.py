"""Registered queries that run a job into scratch tables and read the result."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelvane import schemas
from kelvane.functions.numbers import numeric_round
from kelvane.operators import alerts, codec, dashboard, payload, rollup, windows
from kelvane.plans import fixtures as fx
from kelvane.plans import sql as q
from kelvane.functions.times import width_ms
from kelvane.session import STATE_SETTINGS, conf_scope, scratch_path
from kelvane.sinks import tables
from kelvane.sinks.topics import file_writer
from kelvane.sources import topics
from kelvane.sources.landed import landed_topic
from kelvane.sources.events import as_readings, stream_events
from kelvane.sources.tables import scan
from kelvane.streaming import jobs

ONCE = {"availableNow": True}


def _new_root(spark: SparkSession, name: str) -> str:
    root = scratch_path(spark, name)
    tables.ensure_tables(spark, root)
    return root


def _finish(query) -> None:
    query.awaitTermination()


def _raw(spark, root) -> DataFrame:
    return scan(spark, root, "readings_raw").select(
        F.unix_millis("time").alias("time_ms"), "sensor_id", "room", "temp_c", "humidity",
        "pressure")


def _windows(spark, root) -> DataFrame:
    return scan(spark, root, "readings_aggregated").select(
        F.unix_millis("bucket").alias("bucket_ms"), "room", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"), "max_humidity",
        numeric_round(F.col("avg_humidity"), 6).alias("avg_humidity"))


def _alerts(spark, root) -> DataFrame:
    own_id = F.col("id") == F.xxhash64("room", "window_start")
    return scan(spark, root, "alerts").select(
        "room", F.unix_millis("window_start").alias("window_start_ms"), "max_temp",
        "consecutive_count", own_id.alias("id_follows_key"),
        F.col("time").isNotNull().alias("has_time"))


def raw_insert_replay(spark, folder):
    """Insert, then insert the same keys again with other values."""
    root = _new_root(spark, "raw-insert")
    rows = jobs.with_date(fx.readings(spark, folder))
    tables.insert_first_wins(rows, root, "readings_raw", ["arrival"])
    again = rows.withColumn("temp_c", F.lit(-1.0))
    tables.insert_first_wins(again, root, "readings_raw", ["arrival"])
    return _raw(spark, root)


def aggregated_insert_replay(spark, folder):
    root = _new_root(spark, "aggregated-insert")
    rows = windows.as_table_rows(fx.window_results(spark, folder))
    for _ in range(2):
        tables.insert_first_wins(rows, root, "readings_aggregated", ["bucket"])
    return _windows(spark, root)


def alerts_append(spark, folder):
    root = _new_root(spark, "alerts-append")
    tables.append_alerts(alerts.detect_alerts(fx.window_results(spark, folder)), root)
    return _alerts(spark, root)


REFRESHES = [
    datetime(2024, 1, 12, 7, 20, tzinfo=timezone.utc),
    datetime(2024, 1, 20, 9, 45, tzinfo=timezone.utc),
]
GONE_BEFORE = date(2024, 1, 9)
GONE_BEFORE_MS = int(datetime(2024, 1, 9, tzinfo=timezone.utc).timestamp() * 1000)


def hourly_refresh(spark, folder):
    """Two refreshes of different ranges; hours outside both stay empty."""
    root = _new_root(spark, "hourly")
    tables.insert_first_wins(
        jobs.with_date(fx.readings(spark, folder)), root, "readings_raw", ["arrival"])
    for now in REFRESHES:
        rollup.refresh_hourly(
            spark, f"{root}/readings_raw", f"{root}/hourly_temp", now, "6 days", "1 hour")
    return scan(spark, root, "hourly_temp").select(
        F.unix_millis("bucket").alias("bucket_ms"), "room", "min_temp", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"))


LATE_WEEK = (datetime(2024, 1, 8, tzinfo=timezone.utc), datetime(2024, 1, 10, 5, tzinfo=timezone.utc))
ROLLED_UP = datetime(2024, 1, 25, 12, 30, tzinfo=timezone.utc)


def _ms(at: datetime) -> int:
    return int(at.timestamp() * 1000)


def hourly_refresh_changed(spark, folder):
    """Readings of some hours come in late; a refresh of what changed takes them in."""
    root = _new_root(spark, "hourly-changed")
    rows = jobs.with_date(fx.readings(spark, folder))
    late = F.col("time").between(*map(F.lit, LATE_WEEK)) & (F.col("arrival") % 3 == 0)
    for part in (rows.filter(~late), rows.filter(late), rows.filter(late)):
        tables.insert_first_wins(part, root, "readings_raw", ["arrival"], log_hours=True)
        rollup.refresh_changed(spark, root, ROLLED_UP)
    return scan(spark, root, "hourly_temp").select(
        F.unix_millis("bucket").alias("bucket_ms"), "room", "min_temp", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"))


def _commits(spark, folder, root):
    """Commits in no order of time; one comes twice, and again under another name."""
    rows = jobs.with_date(fx.readings(spark, folder))
    for commit, part in (("c", 2), ("a", 0), ("b", 1), ("a", 0), ("d", 0)):
        tables.insert_first_wins(rows.filter(F.col("arrival") % 3 == part), root, "readings_raw", ["arrival"],
                                 commit=commit)


def hourly_from_partials(spark, folder):
    """The hourly rollup from what each commit stored per window."""
    root = _new_root(spark, "hourly-partials")
    _commits(spark, folder, root)
    return rollup.hourly_from_partials(scan(spark, root, "window_partials")).select(
        F.unix_millis("bucket").alias("bucket_ms"), "room", "min_temp", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"))


def windows_from_partials(spark, folder):
    """Five-minute windows from the same, half of the dates folded."""
    root = _new_root(spark, "window-partials")
    _commits(spark, folder, root)
    tables.fold_partials(spark, root, date(2024, 1, 1), date(2024, 1, 15))
    found = rollup.windows_from_partials(scan(spark, root, "window_partials"))
    return found.select("room", "bucket_ms", "max_temp", numeric_round(F.col("avg_temp"), 6).alias("avg_temp"),
                        "max_humidity", numeric_round(F.col("avg_humidity"), 6).alias("avg_humidity"))


SILENT, SILENT_SINCE = "purchase", datetime(2024, 1, 9, tzinfo=timezone.utc)


def latest_per_room_recent(spark, folder):
    """Newest reading of each room, one of which is silent for weeks, by dates from the newest back."""
    root = _new_root(spark, "latest-recent")
    rows = fx.readings(spark, folder).filter((F.col("room") != SILENT) | (F.col("time") < F.lit(SILENT_SINCE)))
    tables.insert_first_wins(jobs.with_date(rows), root, "readings_raw", ["arrival"])
    stored = scan(spark, root, "readings_raw")
    return dashboard.latest_per_room_recent(stored, stored.select("room"), date(2024, 1, 30)).select(
        F.unix_millis("time").alias("time_ms"), "room", "temp_c")


def stream_raw_idempotent(spark, folder):
    """Read the whole stream twice, the second time with no memory of the first."""
    root = _new_root(spark, "stream-raw")
    for attempt in (1, 2):
        _finish(jobs.start_raw_job(
            as_readings(stream_events(spark, folder)), root, f"{root}/checkpoint-{attempt}",
            ONCE, order=["arrival"]))
    return _raw(spark, root)


def _window_stream(spark, folder, root):
    _finish(jobs.start_window_job(
        as_readings(stream_events(spark, folder)), root, f"{root}/checkpoint-windows", ONCE,
        topic=file_writer(f"{root}/{topics.WINDOW_TOPIC}")))


def stream_window_5min(spark, folder):
    root = _new_root(spark, "stream-windows")
    _window_stream(spark, folder, root)
    return _windows(spark, root)


LAG_FROM = datetime(2024, 1, 5, tzinfo=timezone.utc)
LAGGING = 2


def _land_in_turn(path: str, *parts: DataFrame) -> None:
    """A file for each part, to be read one at a time."""
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)


def stream_window_lagging(spark, folder):
    """Of three source partitions one falls weeks behind; none of its readings is late."""
    root = _new_root(spark, "stream-lagging")
    rows = fx.readings(spark, folder).withColumns({
        "partition": F.pmod("arrival", F.lit(3)).cast("int"), "offset": F.col("arrival")})
    behind = (F.col("partition") == LAGGING) & (F.col("time") >= F.lit(LAG_FROM))
    _land_in_turn(f"{root}/topic", rows.filter(~behind), rows.filter(behind))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/topic")
    _finish(jobs.start_window_job(stream, root, f"{root}/checkpoint", ONCE, by_partition=True, idle="1 day",
                                  partitions=(0, 1, LAGGING)))
    return _windows(spark, root)


SESSION_GAPS = {"gap": "20 minutes", "gaps": {"click": "5 minutes", "view": "45 minutes"}}
SESSION_WAIT = "12 days"


def _sessions(found: DataFrame) -> DataFrame:
    return found.withColumn("avg_temp", numeric_round(F.col("avg_temp"), 6))


def room_sessions(spark, folder):
    """Readings of a room between pauses, with a gap of its own for some rooms."""
    return _sessions(windows.sessions(fx.readings(spark, folder), **SESSION_GAPS))


def stream_sessions(spark, folder):
    """The same as a stream, every seventh reading ten days late."""
    root = _new_root(spark, "stream-sessions")
    rows = fx.readings(spark, folder).withColumn("turn", F.expr(
        "least(datediff(time, DATE'2024-01-01') div 10 + IF(arrival % 7 = 0, 1, 0), 3)"))
    _land_in_turn(f"{root}/topic", *[rows.filter(F.col("turn") == turn).drop("turn") for turn in range(4)])
    stream = spark.readStream.schema(rows.drop("turn").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/topic")
    with conf_scope(spark, STATE_SETTINGS):
        _finish(windows.sessions(stream, **SESSION_GAPS, watermark=SESSION_WAIT).writeStream.outputMode("append")
                .format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(**ONCE)
                .start(f"{root}/sessions"))
    return _sessions(spark.read.parquet(f"{root}/sessions"))


SEEDED_FROM = datetime(2024, 1, 15, tzinfo=timezone.utc)


def stream_alerts_seeded(spark, folder):
    """A stream that starts on a later day, with the runs that stored windows come to."""
    root = _new_root(spark, "stream-seeded")
    found = windows.as_table_rows(fx.window_results(spark, folder))
    tables.insert_first_wins(found, root, "readings_aggregated", ["bucket"])
    stored = scan(spark, root, "readings_aggregated")
    before = stored.filter(F.col("bucket") < F.lit(SEEDED_FROM))
    since = windows.from_table_rows(stored.filter(F.col("bucket") >= F.lit(SEEDED_FROM)))
    file_writer(f"{root}/{topics.WINDOW_TOPIC}")(codec.window_messages(since))
    topic = topics.file_topic(spark, f"{root}/{topics.WINDOW_TOPIC}")
    _finish(jobs.start_alert_job(
        jobs.windows_of_messages(topic), root, f"{root}/checkpoint", ONCE,
        runs=alerts.run_state(windows.from_table_rows(before))))
    return _alerts(spark, root)


def _alert_stream(spark, folder, files_per_batch):
    root = _new_root(spark, "stream-alerts")
    _window_stream(spark, folder, root)
    topic = topics.file_topic(spark, f"{root}/{topics.WINDOW_TOPIC}", files_per_batch)
    _finish(jobs.start_alert_job(
        jobs.windows_of_messages(topic), root, f"{root}/checkpoint-alerts", ONCE,
        topic=file_writer(f"{root}/{topics.ALERT_TOPIC}")))
    return _alerts(spark, root)


def stream_alerts(spark, folder):
    """Alerts from the topic of windows."""
    return _alert_stream(spark, folder, 1000)


def stream_alerts_capped(spark, folder):
    """The same, one file at a time."""
    return _alert_stream(spark, folder, 1)


def published_order(spark, folder):
    """Per room, published windows and how often one follows a later one."""
    root = _new_root(spark, "published-order")
    _window_stream(spark, folder, root)
    messages = spark.read.schema(schemas.TOPIC).parquet(f"{root}/{topics.WINDOW_TOPIC}")
    placed = codec.read_messages(messages, keep=("partition", "offset"))
    by_offset = Window.partitionBy("room").orderBy("partition", "offset")
    return placed.withColumn("before", F.lag("bucket_ms").over(by_offset)).groupBy("room").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") > F.col("bucket_ms")).alias("descents"))


def stream_text_first_wins(spark, folder):
    """Landed lines, two of each reading's key; the earlier line stays."""
    root = _new_root(spark, "stream-text")
    rows = fx.readings(spark, folder)
    copies = rows.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "temp_c", F.when(F.col("copy") == 1, -1.0).otherwise(F.col("temp_c")))
    lines = payload.encode_payloads(copies, keep=("arrival", "copy"))
    # In each file thousand by thousand, the readings ahead of their copies.
    lines.withColumn("part", F.floor(F.col("arrival") / 1000)).repartitionByRange("part").sortWithinPartitions(
        "part", "copy", "arrival").select("value").write.text(f"{root}/landed")
    _finish(jobs.start_payload_job(
        landed_topic(spark, f"{root}/landed", settle=0, span_bytes=1 << 20), root, f"{root}/rejects", f"{root}/checkpoint", ONCE))
    return _raw(spark, root)


def payload_outcome_counts(spark, folder):
    """Payloads accepted and rejected, as the observed counters tell."""
    seen = Observation("outcomes")
    parsed = payload.count_outcomes(payload.parse_payloads(
        fx.bent_payloads(fx.readings(spark, folder))), seen)
    parsed.write.format("noop").mode("overwrite").save()
    counts = seen.get
    return spark.range(1).select(F.lit(counts["accepted"]).cast("bigint").alias("accepted"),
                                 F.lit(counts["rejected"]).cast("bigint").alias("rejected"))


def hourly_refresh_emptied(spark, folder):
    """A second refresh after the readings of some days are gone."""
    root = _new_root(spark, "hourly-emptied")
    rows = jobs.with_date(fx.readings(spark, folder))
    now = REFRESHES[0]
    for name, kept in (("before", rows), ("after", rows.filter(F.to_date("time") >= GONE_BEFORE))):
        raw = f"{root}/raw-{name}"
        kept.select(*schemas.READINGS_RAW.names).write.partitionBy("event_date").parquet(raw)
        rollup.refresh_hourly(spark, raw, f"{root}/hourly_temp", now, "6 days", "1 hour")
    return scan(spark, root, "hourly_temp").select(
        F.unix_millis("bucket").alias("bucket_ms"), "room", "min_temp", "max_temp",
        numeric_round(F.col("avg_temp"), 6).alias("avg_temp"))


def _write_topic(rows: DataFrame, path: str) -> None:
    rows.select(
        F.lit(None).cast("binary").alias("key"), "value",
        F.pmod("number", F.lit(3)).cast("int").alias("partition"),
        F.col("number").alias("offset"),
    ).write.parquet(path)


def _payload_stream(spark, folder, root):
    bent = fx.bent_payloads(fx.readings(spark, folder))
    _write_topic(bent.withColumnRenamed("arrival", "number"), f"{root}/topic")
    _finish(jobs.start_payload_job(
        topics.file_topic(spark, f"{root}/topic"), root, f"{root}/rejects",
        f"{root}/checkpoint", ONCE))


def stream_payloads(spark, folder):
    root = _new_root(spark, "stream-payloads")
    _payload_stream(spark, folder, root)
    return _raw(spark, root)


def stream_payload_rejects(spark, folder):
    root = _new_root(spark, "stream-rejects")
    _payload_stream(spark, folder, root)
    rejects = spark.read.schema(
        "partition int, offset bigint, value binary, reject_reason string"
    ).parquet(f"{root}/rejects")
    return rejects.select(F.col("offset").alias("arrival"), "reject_reason")


def stream_batches(spark, folder):
    """Decoded batches on a topic to stored readings."""
    root = _new_root(spark, "stream-batches")
    fx.bent_batches(fx.readings(spark, folder)).select(
        "resource_metrics", F.pmod("batch", F.lit(3)).cast("int").alias("partition"),
        F.col("batch").alias("offset")).write.parquet(f"{root}/topic")
    schema = T.StructType([T.StructField("resource_metrics", schemas.RESOURCE_METRICS),
                           *schemas.TOPIC.fields[2:]])
    topic = spark.readStream.schema(schema).parquet(f"{root}/topic")
    _finish(jobs.start_raw_job(jobs.readings_of_batches(topic), root, f"{root}/checkpoint", ONCE))
    return _raw(spark, root)


def _snapshots(spark, folder, starts):
    root = _new_root(spark, "stream-snapshot")
    for start in range(starts):
        rows = as_readings(stream_events(spark, folder)).withColumn(
            "ts_nanos", F.unix_millis("time") * 1_000_000)
        _finish(jobs.start_snapshot_job(
            rows, f"{root}/ticks", f"{root}/checkpoint-{start}", trigger=ONCE))
    ticks = spark.read.schema(
        "sensor_id string, room string, temp_c double, humidity double, pressure double, "
        "ts_nanos bigint, tick timestamp").parquet(f"{root}/ticks")
    return ticks.drop("batch", "query")


def stream_snapshot(spark, folder):
    return _snapshots(spark, folder, 1).drop("tick")


def stream_snapshot_restarted(spark, folder):
    """Two runs with a checkpoint each: the ticks of both stay."""
    return _snapshots(spark, folder, 2).groupBy("sensor_id", "room").agg(
        F.count_distinct("tick").alias("ticks"), F.count_distinct("ts_nanos").alias("states"))


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join([q.READINGS, *ctes]) + "\n" + select


RAW_COLUMNS = "time_ms, sensor_id, room, temp_c, humidity, pressure"
FIRST = """kept AS (SELECT *, row_number() OVER (
  PARTITION BY sensor_id, time_ms ORDER BY arrival) AS rn FROM {source})"""
TABLE_COLUMNS = q.WINDOW_COLUMNS
CLOSED = f"""closed AS (SELECT * FROM w
  WHERE bucket_ms + {q.FIVE_MINUTES} <= (SELECT max(time_ms) FROM readings) - 10000)"""
STORED_ALERTS = ("SELECT room, window_start_ms, max_temp, consecutive_count, "
                 "true AS id_follows_key, true AS has_time FROM raised")
GOOD = f"""good AS (SELECT time_ms, sensor_id, room, temp_c, humidity,
  CASE WHEN arrival % 97 = 16 THEN 1000 ELSE pressure END AS pressure, arrival FROM readings
  WHERE arrival % 97 NOT IN (0,1,2,3,4,5,6,7,8,9,10,11,12,13,17,18))"""
REASONS = """CASE arrival % 97 WHEN 1 THEN 'unsupported_version' WHEN 2 THEN 'type:schema_version'
  WHEN 3 THEN 'missing:temp_c' WHEN 4 THEN 'type:temp_c' WHEN 5 THEN 'type:timestamp_ms'
  WHEN 6 THEN 'type:timestamp_ms' WHEN 9 THEN 'not_an_object' WHEN 10 THEN 'invalid_utf8'
  WHEN 11 THEN 'empty' WHEN 17 THEN 'empty' WHEN 18 THEN 'type:pressure'
  ELSE 'malformed_json' END"""
FLAT = """flat AS (
  SELECT sensor_id, CASE WHEN arrival % 11 = 9 THEN '' ELSE room END AS room, temp_c,
         CASE WHEN arrival % 11 = 4 THEN 0 ELSE humidity END AS humidity,
         CASE WHEN arrival % 11 = 7 THEN 0 ELSE pressure END AS pressure,
         time_ms + CASE WHEN arrival % 11 = 5 THEN 1000 ELSE 0 END AS time_ms, arrival
  FROM readings WHERE arrival % 11 NOT IN (2, 3))"""


LATE = f"time_ms BETWEEN {_ms(LATE_WEEK[0])} AND {_ms(LATE_WEEK[1])} AND arrival % 3 = 0"
IN_COMMITS = """ranked AS (SELECT *, row_number() OVER (PARTITION BY sensor_id, time_ms
  ORDER BY CASE arrival % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END, arrival) AS rn FROM readings),
stored AS (SELECT * FROM ranked WHERE rn = 1)"""


SESSIONS = """spaced AS (SELECT *, CASE room WHEN 'click' THEN 300000 WHEN 'view' THEN 2700000 ELSE 1200000 END AS gap,
  lag(time_ms) OVER (PARTITION BY room ORDER BY time_ms) AS before FROM readings),
islands AS (SELECT *, sum(CASE WHEN time_ms - before > gap OR before IS NULL THEN 1 ELSE 0 END)
  OVER (PARTITION BY room ORDER BY time_ms ROWS UNBOUNDED PRECEDING) AS island FROM spaced),
sessions AS (SELECT room, min(time_ms) AS start_ms, max(time_ms) + any_value(gap) AS end_ms, count(*) AS n,
  max(temp_c) AS max_temp, avg(temp_c) AS mean FROM islands GROUP BY room, island)"""
SESSION_COLUMNS = f"room, start_ms, end_ms, n, max_temp, {q.num('mean', 6)} AS avg_temp"


def _hours(now: datetime) -> str:
    low, high = rollup.refresh_range(now, "6 days", "1 hour")
    return (f"(time_ms >= {int(low.timestamp() * 1000)} "
            f"AND time_ms < {int(high.timestamp() * 1000)})")


JOB_QUERIES = {
    "raw_insert_replay": (raw_insert_replay, _with(
        FIRST.format(source="readings"), select=f"SELECT {RAW_COLUMNS} FROM kept WHERE rn = 1")),
    "aggregated_insert_replay": (aggregated_insert_replay, _with(
        q.windows(), select=f"SELECT {TABLE_COLUMNS} FROM w")),
    "alerts_append": (alerts_append, _with(
        q.windows(), q.runs(), f"raised AS ({q.ALERT_ROWS})", select=STORED_ALERTS)),
    "hourly_refresh": (hourly_refresh, _with(select=f"""
        SELECT {q.floor_to('time_ms', q.HOUR)} AS bucket_ms, room, min(temp_c) AS min_temp,
        max(temp_c) AS max_temp, {q.num('avg(temp_c)', 6)} AS avg_temp FROM readings
        WHERE {' OR '.join(_hours(now) for now in REFRESHES)} GROUP BY 1, 2""")),
    "hourly_refresh_changed": (hourly_refresh_changed, _with(
        FIRST.format(source=f"(SELECT *, arrival + CASE WHEN {LATE} THEN 1000000000000 ELSE 0 END AS turn FROM readings)"
                     ).replace("ORDER BY arrival", "ORDER BY turn"), select=f"""
        SELECT {q.floor_to('time_ms', q.HOUR)} AS bucket_ms, room, min(temp_c) AS min_temp,
        max(temp_c) AS max_temp, {q.num('avg(temp_c)', 6)} AS avg_temp FROM kept
        WHERE rn = 1 AND time_ms < {_ms(ROLLED_UP.replace(hour=11, minute=0))} GROUP BY 1, 2""")),
    "hourly_from_partials": (hourly_from_partials, _with(
        IN_COMMITS, select=f"""SELECT {q.floor_to('time_ms', q.HOUR)} AS bucket_ms, room, min(temp_c) AS min_temp,
        max(temp_c) AS max_temp, {q.num('avg(temp_c)', 6)} AS avg_temp FROM stored GROUP BY 1, 2""")),
    "windows_from_partials": (windows_from_partials, _with(
        IN_COMMITS, q.windows(source="stored"), select=f"SELECT {TABLE_COLUMNS} FROM w")),
    "latest_per_room_recent": (latest_per_room_recent, _with(
        f"""heard AS (SELECT * FROM readings WHERE room <> '{SILENT}' OR time_ms < {_ms(SILENT_SINCE)})""",
        FIRST.format(source="heard"), """newest AS (SELECT *, row_number() OVER (
        PARTITION BY room ORDER BY time_ms DESC, sensor_id) AS n FROM kept WHERE rn = 1)""",
        select=f"SELECT time_ms, room, {q.num('temp_c', 1)} AS temp_c FROM newest WHERE n = 1")),
    "stream_raw_idempotent": (stream_raw_idempotent, _with(
        FIRST.format(source="readings"), select=f"SELECT {RAW_COLUMNS} FROM kept WHERE rn = 1")),
    "stream_window_5min": (stream_window_5min, _with(
        q.windows(), CLOSED, select=f"SELECT {TABLE_COLUMNS} FROM closed")),
    "stream_window_lagging": (stream_window_lagging, _with(
        q.windows(), f"""closed AS (SELECT * FROM w WHERE bucket_ms + {q.FIVE_MINUTES} <= (SELECT min(m) FROM (
          SELECT max(time_ms) AS m FROM readings GROUP BY arrival % 3)) - 10000)""",
        select=f"SELECT {TABLE_COLUMNS} FROM closed")),
    "room_sessions": (room_sessions, _with(SESSIONS, select=f"SELECT {SESSION_COLUMNS} FROM sessions")),
    "stream_sessions": (stream_sessions, _with(SESSIONS, select=f"""SELECT {SESSION_COLUMNS} FROM sessions
        WHERE end_ms <= (SELECT max(time_ms) FROM readings) - {width_ms(SESSION_WAIT)}""")),
    "stream_alerts_seeded": (stream_alerts_seeded, _with(
        q.windows(), q.runs(), f"raised AS ({q.ALERT_ROWS} AND bucket_ms >= {_ms(SEEDED_FROM)})", select=STORED_ALERTS)),
    "stream_alerts": (stream_alerts, _with(
        q.windows(), CLOSED, q.runs("closed"), f"raised AS ({q.ALERT_ROWS})",
        select=STORED_ALERTS)),
    "stream_payloads": (stream_payloads, _with(
        GOOD, FIRST.format(source="good"), select=f"SELECT {RAW_COLUMNS} FROM kept WHERE rn = 1")),
    "stream_payload_rejects": (stream_payload_rejects, _with(select=f"""
        SELECT arrival, {REASONS} AS reject_reason FROM readings
        WHERE arrival % 97 IN (0,1,2,3,4,5,6,7,8,9,10,11,12,13,17,18)""")),
    "stream_snapshot": (stream_snapshot, _with(select="""
        SELECT sensor_id, room, arg_max(temp_c, arrival) AS temp_c,
        arg_max(humidity, arrival) AS humidity, arg_max(pressure, arrival) AS pressure,
        arg_max(time_ms, arrival) * 1000000 AS ts_nanos FROM readings GROUP BY 1, 2""")),
}
JOB_QUERIES |= {
    "stream_batches": (stream_batches, _with(
        FLAT, FIRST.format(source="flat"), select=f"SELECT {RAW_COLUMNS} FROM kept WHERE rn = 1")),
    "stream_alerts_capped": (stream_alerts_capped, JOB_QUERIES["stream_alerts"][1]),
    "published_order": (published_order, _with(
        q.windows(), CLOSED, select="""SELECT room, count(*) AS n, CAST(0 AS BIGINT) AS descents
        FROM closed GROUP BY 1""")),
    "stream_text_first_wins": (stream_text_first_wins, _with(
        FIRST.format(source="readings"), select=f"SELECT {RAW_COLUMNS} FROM kept WHERE rn = 1")),
    "payload_outcome_counts": (payload_outcome_counts, _with(select="""
        SELECT count(*) FILTER (NOT bad) AS accepted, count(*) FILTER (bad) AS rejected FROM (
        SELECT arrival % 97 IN (0,1,2,3,4,5,6,7,8,9,10,11,12,13,17,18) AS bad FROM readings)""")),
    "hourly_refresh_emptied": (hourly_refresh_emptied, _with(select=f"""
        SELECT {q.floor_to('time_ms', q.HOUR)} AS bucket_ms, room, min(temp_c) AS min_temp,
        max(temp_c) AS max_temp, {q.num('avg(temp_c)', 6)} AS avg_temp FROM readings
        WHERE {_hours(REFRESHES[0])} AND time_ms >= {GONE_BEFORE_MS} GROUP BY 1, 2""")),
    "stream_snapshot_restarted": (stream_snapshot_restarted, _with(select="""
        SELECT sensor_id, room, CAST(2 AS BIGINT) AS ticks, CAST(1 AS BIGINT) AS states
        FROM readings GROUP BY 1, 2""")),
}
