"""Windows closed by the slowest source partition, and ticks that need no news.

Both are keyed state with processing-time timers, for which Spark runs
micro-batches also while nothing arrives. They need the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kelvane.functions.numbers import infinite_to_zero
from kelvane.functions.times import floor_ms, to_ms, width_ms

NEVER = -(2**62)
# Reading values of a window, in the order of its state.
VALUES = ("temp_c", "humidity")
DATED = ("shard int, partition int, beat boolean, room string, time_ms bigint, bucket_ms bigint, "
         "temp_c double, has_temp_c boolean, humidity double, has_humidity boolean")

def with_beats(rows: DataFrame, shards: int) -> DataFrame:
    """Rows, and for each shard the newest time of every source partition.

    A shard sees the rows of its rooms only, but windows wait for all
    partitions. Each Arrow batch adds ``shards`` rows per partition in it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            if not batch.num_rows:
                continue
            newest = pa.Table.from_batches([batch]).group_by("partition").aggregate([("time_ms", "max")])
            seen = list(zip(newest["partition"].to_pylist(), newest["time_ms_max"].to_pylist()))
            beats = [{"shard": shard, "partition": partition, "beat": True, "time_ms": ms}
                     for partition, ms in seen if ms is not None for shard in range(shards)]
            yield pa.RecordBatch.from_pylist(beats, schema=batch.schema)

    return rows.mapInArrow(run, DATED)


STATE = "room string, bucket_ms bigint, " + ", ".join(
    f"n_{v} bigint, sum_{v} double, max_{v} double" for v in VALUES)


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def _as_state(rows: pd.DataFrame) -> pd.DataFrame:
    """Each reading as a window of one; a value that is absent adds nothing."""
    out = rows[["room", "bucket_ms"]].copy()
    for value in VALUES:
        has = rows[f"has_{value}"].to_numpy(dtype=bool)
        given = rows[value].to_numpy(dtype=float)
        out[f"n_{value}"], out[f"sum_{value}"] = has.astype(np.int64), np.where(has, given, 0.0)
        out[f"max_{value}"] = np.where(has, given, -np.inf)
    return out


def _merged(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """One row per room and window; NaN is above all, as in the batch form."""
    rows = pd.concat(parts)
    room = pd.factorize(rows["room"], use_na_sentinel=False)[0]
    bucket = rows["bucket_ms"].to_numpy(dtype=np.int64)
    order = np.lexsort((bucket, room))
    rows, room, bucket = rows.iloc[order], room[order], bucket[order]
    first = np.flatnonzero(np.append(True, (np.diff(room) != 0) | (np.diff(bucket) != 0)))
    out = {"room": rows["room"].to_numpy(dtype=object)[first], "bucket_ms": bucket[first]}
    for name in _names(STATE)[2:]:
        reduce = np.maximum if name.startswith("max") else np.add
        out[name] = reduce.reduceat(rows[name].to_numpy(), first)
    return pd.DataFrame(out)


class PartitionedWindows(StatefulProcessor):
    """Open windows of a shard's rooms, and how far each source partition has come.

    Windows that open and close within one micro-batch never become state.
    """

    def __init__(self, width: int, delay: int, idle: int, partitions: list[int]) -> None:
        self.width, self.delay, self.idle, self.partitions = width, delay, idle, partitions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getListState("clock", "partition int, newest bigint, seen bigint")
        self.mark = handle.getValueState("mark", "ms bigint")
        self.open = handle.getListState("open", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.mark.exists():
            mark = self.mark.get()[0]
            clock = {partition: (newest, seen) for partition, newest, seen in self.clock.get()}
        else:  # the partitions expected are waited for
            mark, clock = NEVER, {partition: (NEVER, now) for partition in self.partitions}
        parts = self._stored()
        for part in rows:
            beats = part["beat"].to_numpy(dtype=bool)
            for partition, ms in part[beats].groupby("partition")["time_ms"].max().items():
                clock[int(partition)] = max(int(ms), clock.get(int(partition), (NEVER,))[0]), now
            fresh = part[~beats & (part["bucket_ms"] + self.width > mark).to_numpy()]
            if len(fresh):
                parts = [_merged([*parts, _as_state(fresh)])]
        return self._close(mark, clock, parts, now)

    def _stored(self) -> list[pd.DataFrame]:
        stored = list(self.open.get()) if self.open.exists() else []
        return [pd.DataFrame([tuple(r) for r in stored], columns=_names(STATE))] if stored else []

    def _close(self, mark: int, clock: dict, parts: list[pd.DataFrame], now: int) -> Iterator[pd.DataFrame]:
        live = [newest for newest, seen in clock.values() if now - seen < self.idle]
        if live:
            mark = max(mark, min(live) - self.delay)
        self.mark.update((mark,))
        self.clock.put([(p, newest, seen) for p, (newest, seen) in clock.items()])
        if live and len(clock) > 1:
            # A partition that falls silent meanwhile is let go then; equal timers are one.
            self.handle.registerTimer((now // self.idle + 2) * self.idle)
        if not parts:
            return
        windows = parts[0]
        done = (windows["bucket_ms"] + self.width <= mark).to_numpy()
        left = windows[~done]
        if len(left):
            self.open.put([(None if pd.isna(r[0]) else r[0], *r[1:])
                           for r in zip(*(left[name].tolist() for name in left.columns))])
        else:
            self.open.clear()
        closed = windows[done]
        if len(closed):
            yield closed

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock = {partition: (newest, seen) for partition, newest, seen in self.clock.get()}
        return self._close(self.mark.get()[0], clock, self._stored(), timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def tumble_by_partition(
    readings: DataFrame, width: str = "5 minutes", delay: str = "10 seconds", idle: str = "1 minute",
    partitions: tuple[int, ...] = (), shards: int = 16,
) -> DataFrame:
    """``windows.tumble`` of a stream with a watermark for each source partition.

    The least of them, less ``delay``, closes windows: a partition that lags
    behind loses nothing, unless nothing comes from it for the time ``idle``.
    ``partitions`` names those to wait for before they have sent anything.
    Rooms are spread over ``shards``; a shard holds the open windows of its rooms.
    """
    ms = to_ms(F.col("time"))
    rows = readings.select(
        F.pmod(F.xxhash64("room"), F.lit(shards)).cast("int").alias("shard"), F.col("partition").cast("int").alias(
            "partition"), F.lit(False).alias("beat"), "room", ms.alias("time_ms"),
        floor_ms(ms, width_ms(width)).alias("bucket_ms"),
        *[c for v in VALUES for c in (F.col(v), F.col(v).isNotNull().alias(f"has_{v}"))])
    closed = with_beats(rows, shards).groupBy("shard").transformWithStateInPandas(
        PartitionedWindows(width_ms(width), width_ms(delay), width_ms(idle), list(partitions)),
        STATE, "Append", "ProcessingTime")

    def given(value: str, found: Column) -> Column:
        # NaN comes out of pandas as null, but only a window without values has none.
        return F.when(F.col(f"n_{value}") > 0, F.coalesce(found, F.lit(float("nan"))))

    columns = []
    for value, name in zip(VALUES, ("temp", "humidity")):
        columns += [infinite_to_zero(given(value, F.col(f"max_{value}"))).alias(f"max_{name}"),
                    given(value, F.col(f"sum_{value}") / F.col(f"n_{value}")).alias(f"avg_{name}")]
    return closed.select("room", "bucket_ms", *columns)


SNAPSHOT = "sensor_id string, room string, temp_c double, humidity double, pressure double, ts_nanos bigint"


class Ticker(StatefulProcessor):
    """The last values of a sensor, sent again at every tick."""

    def __init__(self, period: int, places: int) -> None:
        self.period, self.places = period, [f"place_{i}" for i in range(places)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", SNAPSHOT.split(", ", 2)[2])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = [part.sort_values(self.places, kind="stable").iloc[-1:] for part in rows]
        row = pd.concat(newest).sort_values(self.places, kind="stable").iloc[-1]
        if not self.last.exists():
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer((now // self.period + 1) * self.period)
        number = lambda x: None if pd.isna(x) else float(x)
        self.last.update((*(number(row[c]) for c in ("temp_c", "humidity", "pressure")), int(row["ts_nanos"])))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Every tick up to now, those a busy stream missed included."""
        due, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentProcessingTimeInMs()
        ticks = np.arange(due, now + 1, self.period)
        self.handle.registerTimer(int(due + len(ticks) * self.period))
        values = self.last.get()
        rows = pd.DataFrame([(*key, *values)] * len(ticks), columns=_names(SNAPSHOT))
        yield rows.assign(tick_ms=ticks)

    def close(self) -> None:
        pass


def live_snapshots(readings: DataFrame, period: str = "10 seconds", arrival: tuple[str, ...] = ("arrival",)) -> DataFrame:
    """The latest values of each (sensor, room) at every tick of the clock, news or not.

    Of the rows of a micro-batch the last in ``arrival``, whole numbers or times,
    counts; later micro-batches come later. Adds ``tick``.
    """
    rows = readings.select(*_names(SNAPSHOT), *[F.col(c).cast("long").alias(f"place_{i}") for i, c in enumerate(arrival)])
    ticks = rows.groupBy("sensor_id", "room").transformWithStateInPandas(
        Ticker(width_ms(period), len(arrival)), SNAPSHOT + ", tick_ms bigint", "Append", "ProcessingTime")
    return ticks.withColumn("tick", F.timestamp_millis("tick_ms")).drop("tick_ms")
