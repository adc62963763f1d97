"""Hourly rollup and its incremental refresh."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane import schemas
from kelvane.functions.numbers import infinite_to_zero
from kelvane.functions.times import width_ms
from kelvane.session import shared_root
from kelvane.sources.tables import stored_dates, stored_near

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def hourly(readings: DataFrame, width: str = "1 hour") -> DataFrame:
    """Min, max and mean temperature per room and hour."""
    return (
        readings.groupBy(F.window("time", width).alias("w"), "room")
        .agg(
            F.min("temp_c").alias("min_temp"),
            F.max("temp_c").alias("max_temp"),
            F.avg("temp_c").alias("avg_temp"),
        )
        .select(F.col("w.start").alias("bucket"), "room", "min_temp", "max_temp", "avg_temp")
    )


def partials(readings: DataFrame, width: str = "5 minutes") -> DataFrame:
    """What readings come to per room and window, in a form that can be merged.

    Sums and counts in place of means: rows of several commits add up.
    """
    return _dated(readings.groupBy(F.window("time", width).alias("w"), "room").agg(
        F.count("temp_c").alias("n_temp"), F.sum("temp_c").alias("sum_temp"),
        F.min("temp_c").alias("min_temp"), F.max("temp_c").alias("max_temp"),
        F.count("humidity").alias("n_humidity"), F.sum("humidity").alias("sum_humidity"),
        F.max("humidity").alias("max_humidity")))


def merged(partials: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Partial windows merged to wider or the same ones, in the same form.

    ``width`` is a multiple of the width they were made with.
    """
    return _dated(partials.groupBy(F.window("bucket", width).alias("w"), "room").agg(
        F.sum("n_temp").alias("n_temp"), F.sum("sum_temp").alias("sum_temp"),
        F.min("min_temp").alias("min_temp"), F.max("max_temp").alias("max_temp"),
        F.sum("n_humidity").alias("n_humidity"), F.sum("sum_humidity").alias("sum_humidity"),
        F.max("max_humidity").alias("max_humidity")))


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.col("w.start")).withColumn("event_date", F.to_date("bucket")).drop("w")


def hourly_from_partials(partials: DataFrame, width: str = "1 hour") -> DataFrame:
    """``hourly`` without the readings."""
    return merged(partials, width).select(
        "bucket", "room", "min_temp", "max_temp", _mean("temp").alias("avg_temp"))


def windows_from_partials(partials: DataFrame, width: str = "5 minutes") -> DataFrame:
    """``windows.tumble`` without the readings."""
    return merged(partials, width).select(
        "room", F.unix_millis("bucket").alias("bucket_ms"), infinite_to_zero(F.col("max_temp")).alias("max_temp"),
        _mean("temp").alias("avg_temp"), infinite_to_zero(F.col("max_humidity")).alias("max_humidity"),
        _mean("humidity").alias("avg_humidity"))


def _mean(name: str) -> Column:
    return F.when(F.col(f"n_{name}") > 0, F.col(f"sum_{name}") / F.col(f"n_{name}"))


def refresh_range(
    now: datetime, start_offset: str = "3 hours", end_offset: str = "1 hour",
    width: str = "1 hour",
) -> tuple[datetime, datetime]:
    """Whole buckets inside [now - start_offset, now - end_offset)."""
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    step = timedelta(milliseconds=width_ms(width))
    low = now - timedelta(milliseconds=width_ms(start_offset))
    high = now - timedelta(milliseconds=width_ms(end_offset))
    return EPOCH - ((EPOCH - low) // step) * step, EPOCH + ((high - EPOCH) // step) * step


def refresh_hourly(
    spark: SparkSession,
    raw_path: str,
    rollup_path: str,
    now: datetime,
    start_offset: str = "3 hours",
    end_offset: str = "1 hour",
) -> None:
    """Recompute the buckets of the refresh range; others stay as stored.

    Reads only the dates the range touches and replaces only those date
    partitions; a date that has no bucket any more is replaced by nothing. The
    result is checkpointed first, as it is written over a table it reads.
    """
    low, high = refresh_range(now, start_offset, end_offset)
    if low >= high:
        return
    shared_root(spark)
    t0, t1 = F.lit(low), F.lit(high)
    dates = F.col("event_date").between(low.date(), (high - timedelta(microseconds=1)).date())
    raw = spark.read.schema(schemas.READINGS_RAW).parquet(raw_path)
    fresh = hourly(raw.filter(dates & (F.col("time") >= t0) & (F.col("time") < t1))).withColumn(
        "event_date", F.to_date("bucket"))
    stored = spark.read.schema(schemas.HOURLY_TEMP).parquet(rollup_path)
    kept = stored.filter(dates & ((F.col("bucket") < t0) | (F.col("bucket") >= t1)))
    _replace_dates(fresh.unionByName(kept), stored.filter(dates), rollup_path)


def _replace_dates(rows: DataFrame, stored: DataFrame, path: str) -> None:
    """Write ``rows`` over the dates of ``stored``; they may come from it."""
    rows = rows.checkpoint()
    had = {r.event_date for r in stored.select("event_date").distinct().collect()}
    rows.hint("rebalance", F.col("event_date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
    # Dynamic overwriting leaves dates without rows alone.
    has = {r.event_date for r in rows.select("event_date").distinct().collect()}
    nothing = rows.sparkSession.createDataFrame([], schemas.HOURLY_TEMP).drop("event_date")
    for day in sorted(had - has):
        nothing.write.mode("overwrite").parquet(f"{path}/event_date={day}")


def refresh_changed(
    spark: SparkSession, root: str, now: datetime, end_offset: str = "1 hour", start_offset: str | None = None,
) -> None:
    """Recompute the hours that got readings since they were last rolled up.

    The insert notes them in ``hourly_stale``; those before ``now - end_offset``
    (and, if given, from ``now - start_offset`` on) are recomputed, however old,
    and cut from the log. Of the readings only the dates and time spans of those
    hours are read, of the rollup only those dates. Not while an insert runs. A
    refresh that fails is repeated in full: the log is cut last.
    """
    shared_root(spark)
    low, high = refresh_range(now, start_offset or end_offset, end_offset)
    log = spark.read.schema(schemas.HOURLY_STALE).parquet(f"{root}/hourly_stale").distinct().checkpoint()
    due = F.col("bucket") < F.lit(high)
    if start_offset is not None:
        due &= F.col("bucket") >= F.lit(low)
    stale = log.filter(due).withColumn("event_date", F.to_date("bucket"))
    spans = stale.groupBy("event_date").agg(
        F.min(F.unix_micros("bucket")).alias("low"),
        (F.max(F.unix_micros("bucket")) + 3_600_000_000 - 1).alias("high")).collect()  # one row per date
    if not spans:
        return
    raw = stored_near(spark, f"{root}/readings_raw", schemas.READINGS_RAW, "time", spans).withColumn(
        "bucket", F.date_trunc("hour", "time"))
    hours = ["event_date", "bucket", "room"]
    fresh = hourly(raw.join(stale, hours, "left_semi")).withColumn("event_date", F.to_date("bucket"))
    path = f"{root}/hourly_temp"
    stored = stored_dates(spark, path, schemas.HOURLY_TEMP, [s["event_date"] for s in spans])
    kept = stored.join(stale, hours, "left_anti").select(*schemas.HOURLY_TEMP.names)
    _replace_dates(fresh.select(*schemas.HOURLY_TEMP.names).union(kept), stored, path)
    log.filter(~due).coalesce(1).write.mode("overwrite").parquet(f"{root}/hourly_stale")
