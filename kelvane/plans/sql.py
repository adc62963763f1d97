"""SQL fragments shared by the counterparts of the registered queries."""

from __future__ import annotations

FIVE_MINUTES = 300_000
HOUR = 3_600_000
DAY = 86_400_000

READINGS = """readings AS (
  SELECT epoch_us(ts) // 1000 AS time_ms, 'sensor-' || user_id AS sensor_id, event_type AS room,
         value AS temp_c,
         CAST(regexp_extract(props, '"k": *(-?[0-9.]+)', 1) AS DOUBLE) AS humidity,
         CAST(1000 + event_id % 30 AS DOUBLE) AS pressure, event_id AS arrival
  FROM events)"""


def num(expression: str, digits: int) -> str:
    """Round half away from zero after cutting to 15 significant digits."""
    return (f"CAST(round(CAST(printf('%.14e', {expression}) AS DECIMAL(38,15)), {digits}) "
            "AS DOUBLE)")


def floor_to(column: str, step: int) -> str:
    return f"({column} - {column} % {step})"


def windows(step: int = FIVE_MINUTES, source: str = "readings", name: str = "w",
            humidity: str = "humidity") -> str:
    return f"""{name} AS (
  SELECT room, {floor_to('time_ms', step)} AS bucket_ms, max(temp_c) AS max_temp,
         avg(temp_c) AS avg_temp, max({humidity}) AS max_humidity, avg({humidity}) AS avg_humidity
  FROM {source} GROUP BY 1, 2)"""


WINDOW_COLUMNS = (f"room, bucket_ms, max_temp, {num('avg_temp', 6)} AS avg_temp, "
                  f"max_humidity, {num('avg_humidity', 6)} AS avg_humidity")


def runs(source: str = "w", gap: bool = False, threshold: float = 25.0) -> str:
    """Common table expressions ending in ``runs`` with ``run_len``."""
    broken = f"NOT (max_temp > {threshold})"
    if gap:
        broken = f"{broken} OR coalesce(bucket_ms - before > {FIVE_MINUTES}, false)"
    return f"""seen AS (
  SELECT *, lag(bucket_ms) OVER o AS before, row_number() OVER o AS rn FROM {source}
  WINDOW o AS (PARTITION BY room ORDER BY bucket_ms, max_temp)),
marked AS (
  SELECT *, sum(CASE WHEN {broken} THEN 1 ELSE 0 END)
            OVER (PARTITION BY room ORDER BY rn) AS grp FROM seen),
runs AS (
  SELECT *, CAST(sum(CASE WHEN max_temp > {threshold} THEN 1 ELSE 0 END)
            OVER (PARTITION BY room, grp ORDER BY rn) AS INTEGER) AS run_len FROM marked)"""


ALERT_ROWS = """SELECT room, bucket_ms AS window_start_ms, max_temp, run_len AS consecutive_count
FROM runs WHERE max_temp > 25.0 AND run_len >= 3"""

SNAPSHOTS = """firsts AS (
  SELECT sensor_id, room, {tick} AS tick_ms, arg_max(temp_c, arrival) AS temp_c,
         arg_max(humidity, arrival) AS humidity, arg_max(pressure, arrival) AS pressure,
         arg_max(time_ms, arrival) * 1000000 AS ts_nanos
  FROM readings GROUP BY 1, 2, 3),
ticks AS (SELECT unnest(range(min(tick_ms), max(tick_ms) + 1, {step})) AS tick_ms FROM firsts),
pairs AS (SELECT sensor_id, room, min(tick_ms) AS start_ms FROM firsts GROUP BY 1, 2),
grid AS (SELECT p.sensor_id, p.room, t.tick_ms FROM pairs p JOIN ticks t
         ON t.tick_ms >= p.start_ms),
snaps AS (SELECT g.sensor_id, g.room, g.tick_ms, f.temp_c, f.humidity, f.pressure, f.ts_nanos
          FROM grid g ASOF JOIN firsts f ON g.sensor_id = f.sensor_id AND g.room = f.room
          AND g.tick_ms >= f.tick_ms)"""


def snapshots(step: int) -> str:
    return SNAPSHOTS.format(tick=f"(time_ms - time_ms % {step} + {step})", step=step)
