"""Runs of consecutive hot windows, as a batch transform.

A plain window over each room would put a room's whole history into one task.
Here every (room, chunk of time) is counted on its own and the count carried
into a chunk comes from one summary row per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvane.functions.numbers import exceeds
from kelvane.functions.times import floor_ms, width_ms

# The default alert rule.
MAX_TEMP_THRESHOLD = 25.0
CONSECUTIVE_THRESHOLD = 3


def hot_runs(
    window_results: DataFrame,
    threshold: float = MAX_TEMP_THRESHOLD,
    gap_resets: bool = False,
    dedupe: bool = False,
    width: str = "5 minutes",
    chunk: str = "7 days",
) -> DataFrame:
    """Add ``run_len``: hot windows in a row up to this one, 0 where not hot.

    By default only received windows count: a missing window does not end a
    run and a redelivered one counts again. ``gap_resets`` ends a run where a
    window is missing; ``dedupe`` counts a redelivered window once.
    """
    # The rows feed two branches. This filter and the outer join below keep the
    # optimizer from adding its own to one of them, so that both share a shuffle.
    rows = window_results.filter(F.col("room").isNotNull()).withColumn(
        "_chunk", floor_ms(F.col("bucket_ms"), width_ms(chunk)))
    # The one shuffle: whatever follows groups by room, chunk and more.
    rows = rows.repartition("room", "_chunk")
    if dedupe:
        rest = [c for c in window_results.columns if c not in ("room", "bucket_ms")]
        rows = rows.groupBy("room", "_chunk", "bucket_ms").agg(
            F.max_by(F.struct(*rest), "max_temp").alias("_r")).select(
            "room", "_chunk", "bucket_ms", "_r.*", F.lit(1).alias("_copies"))
    else:
        # Copies count as one row and part again at the end.
        rows = rows.groupBy("room", "_chunk", *[c for c in window_results.columns if c != "room"]).agg(
            F.count("*").alias("_copies"))
    hot = exceeds(F.col("max_temp"), threshold)
    rows = rows.withColumn("_hot", F.when(hot, F.col("_copies")).otherwise(0))

    ordered = Window.partitionBy("room", "_chunk").orderBy("bucket_ms", "max_temp")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    broken = F.col("_hot") == 0
    if gap_resets:
        step = width_ms(width)
        broken = broken | F.coalesce(
            F.col("bucket_ms") - F.lag("bucket_ms").over(ordered) > step, F.lit(False))
    rows = rows.withColumn("_broken", broken).withColumn("_hots", F.sum("_hot").over(so_far))
    # Hot windows counted before the latest break; null while none has occurred.
    rows = rows.withColumn(
        "_base", F.max(F.when(F.col("_broken"), F.col("_hots") - F.col("_hot"))).over(so_far))

    chunks = rows.groupBy("room", "_chunk").agg(
        F.sum("_copies").alias("_n"),
        (F.sum("_hot") - F.max("_base")).alias("_tail"),
        F.min("bucket_ms").alias("_first"),
        F.max("bucket_ms").alias("_last"),
    )
    # One row per room and chunk of time from here on.
    by_chunk = Window.partitionBy("room").orderBy("_chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    cut = F.lit(False)
    if gap_resets:
        cut = F.coalesce(F.col("_first") - F.lag("_last").over(by_chunk) > step, F.lit(False))
    chunks = (
        chunks.withColumn("_cut", cut)
        .withColumn("_whole", F.col("_tail").isNull())
        .withColumn("_sum", F.sum(F.when(F.col("_whole"), F.col("_n")).otherwise(0)).over(
            by_chunk.rowsBetween(Window.unboundedPreceding, 0)))
        # What a chunk hands on, relative to the running sum of unbroken chunks.
        .withColumn("_hand_on", F.when(~F.col("_whole"), F.col("_tail") - F.col("_sum"))
                    .when(F.col("_cut"), F.col("_n") - F.col("_sum")))
        .withColumn("_carry", F.when(F.col("_cut"), F.lit(0)).otherwise(
            F.coalesce(F.lag("_sum").over(by_chunk), F.lit(0))
            + F.coalesce(F.last("_hand_on", ignorenulls=True).over(before), F.lit(0))))
        .select("room", "_chunk", "_carry")
    )
    run = F.col("_hots") - F.coalesce("_base", -F.col("_carry"))
    first = run - F.col("_hot") + 1
    return (
        rows.join(chunks, ["room", "_chunk"], "left")
        .withColumn("_first", F.when(F.col("_hot") > 0, first).otherwise(0))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), (F.col("_copies") - 1).cast("int"))))
        .withColumn("run_len", F.when(F.col("_hot") > 0, F.col("_first") + F.col("_copy"))
                    .otherwise(0).cast("int"))
        .select(*window_results.columns, "run_len")
    )


def detect_alerts(
    window_results: DataFrame,
    threshold: float = MAX_TEMP_THRESHOLD,
    consecutive: int = CONSECUTIVE_THRESHOLD,
    **options,
) -> DataFrame:
    """One alert for the N-th hot window of a run and for every later one."""
    return (
        hot_runs(window_results, threshold, **options)
        .filter((F.col("run_len") >= consecutive) & (F.col("run_len") > 0))
        .select(
            "room", F.col("bucket_ms").alias("window_start_ms"), "max_temp",
            F.col("run_len").alias("consecutive_count"))
    )


def run_state(window_results: DataFrame, threshold: float = MAX_TEMP_THRESHOLD, **options) -> DataFrame:
    """``room, length, last``: each room's run at its last window, and that window.

    From stored windows, what a stream has to know to go on behind them.
    """
    newest = F.struct("bucket_ms", "max_temp", "run_len")
    return hot_runs(window_results, threshold, **options).groupBy("room").agg(
        F.max_by("run_len", newest).alias("length"), F.max("bucket_ms").alias("last"))
