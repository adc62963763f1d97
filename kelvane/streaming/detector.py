"""Per-room counter of consecutive hot windows, kept as streaming state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kelvane import schemas
from kelvane.functions.times import width_ms
from kelvane.operators.alerts import CONSECUTIVE_THRESHOLD, MAX_TEMP_THRESHOLD

NEVER = -(2**62)


class HotRunCounter(StatefulProcessor):
    """Carries a room's run from one micro-batch to the next.

    Windows count in the order of their offsets, so where a micro-batch ends
    makes no difference. State: length of the run and the last window counted.
    """

    def __init__(self, threshold: float, consecutive: int, step_ms: int, gap_resets: bool, dedupe: bool):
        self.threshold = threshold
        self.consecutive = consecutive
        self.step_ms = step_ms
        self.gap_resets = gap_resets
        self.dedupe = dedupe

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "length int, last bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        run = initialState.iloc[0]
        self.run.update((int(run["length"]), int(run["last"])))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # One row per window of the room that this micro-batch brings.
        windows = pd.concat(list(rows)).sort_values(["partition", "offset"], kind="stable")
        carried, last = self.run.get() if self.run.exists() else (0, NEVER)
        bucket = windows["bucket_ms"].to_numpy()
        newest = np.maximum.accumulate(np.append(last, bucket))
        if self.dedupe:
            fresh = bucket > newest[:-1]
            windows, bucket = windows[fresh], bucket[fresh]
            newest = np.append(last, bucket)
            if not len(windows):
                return
        hot = windows["max_temp"].to_numpy() > self.threshold  # false for NaN
        hots = np.cumsum(hot)
        base = np.where(hot, -carried, hots)
        if self.gap_resets:
            gap = (bucket - newest[:-1] > self.step_ms) & (newest[:-1] > NEVER)
            base = np.where(gap & hot, hots - 1, base)
        length = np.where(hot, hots - np.maximum.accumulate(base), 0)
        self.run.update((int(length[-1]), int(newest[-1])))
        raised = length >= max(self.consecutive, 1)
        if not raised.any():
            return
        yield pd.DataFrame({
            "room": np.full(int(raised.sum()), key[0], dtype=object),
            "window_start_ms": bucket[raised],
            "max_temp": windows["max_temp"].to_numpy()[raised],
            "consecutive_count": length[raised].astype("int32"),
        })

    def close(self) -> None:
        pass


def stream_alerts(
    window_results: DataFrame,
    threshold: float = MAX_TEMP_THRESHOLD,
    consecutive: int = CONSECUTIVE_THRESHOLD,
    gap_resets: bool = False,
    dedupe: bool = False,
    width: str = "5 minutes",
    runs: DataFrame | None = None,
) -> DataFrame:
    """Streaming twin of ``detect_alerts``; needs the RocksDB state store.

    ``runs`` (room, length, last) are taken over when a checkpoint is new: what
    came before them need not be read again.

    Windows of a topic count in the order of (partition, offset). Without these
    columns, as from a table, a micro-batch is put in order of time, which does
    not help a window that comes in a later one than its successor. With
    ``dedupe`` a window no later than the last one counted is a redelivery.
    """
    rows = window_results
    if "offset" not in rows.columns:
        rows = rows.withColumns({"partition": F.lit(0), "offset": F.col("bucket_ms")})
    return rows.select("room", "bucket_ms", "max_temp", "partition", "offset").groupBy(
        "room").transformWithStateInPandas(
        statefulProcessor=HotRunCounter(threshold, consecutive, width_ms(width), gap_resets, dedupe),
        outputStructType=schemas.ALERT,
        outputMode="Append",
        timeMode="None",
        initialState=None if runs is None else runs.select(
            "room", F.col("length").cast("int").alias("length"), F.col("last").cast("bigint").alias("last")).groupBy("room"),
    )


def stored_runs(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``room, length, last`` of every room, from the state of an alert job."""
    state = spark.read.format("statestore").option("stateVarName", "run").load(checkpoint)
    return state.select("key.room", "value.length", "value.last")
