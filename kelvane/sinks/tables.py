"""Stored tables: creation, first-write-wins insert, alert append."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kelvane import schemas
from kelvane.operators import rollup
from kelvane.operators.dedup import first_wins
from kelvane.session import shared_root
from kelvane.sources.tables import stored_dates, stored_near

# Unique keys of the stored tables; the date follows from the time and prunes.
UNIQUE_KEYS = {
    "readings_raw": ["sensor_id", "time"],
    "readings_aggregated": ["room", "bucket"],
}

# Rows per statement of a database sink. How often a sink flushes is
# the trigger of its stream; how often a write is tried, ``spark.task.maxFailures``.
BATCH_ROWS = {"readings_raw": 100, "readings_aggregated": 50, "alerts": 10}


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Create the empty tables that do not exist yet."""
    for name, (schema, partition) in schemas.TABLES.items():
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        if partition:
            writer = writer.partitionBy(partition)
        writer.parquet(f"{root}/{name}")


def insert_first_wins(
    batch: DataFrame, root: str, table: str, order: list[str], keys: list[str] | None = None,
    log_hours: bool = False, commit: str | None = None,
) -> None:
    """Insert rows whose key is not stored yet; of equal keys the first in ``order``.

    Safe to repeat: rows a failed attempt stored are found and skipped. One
    writer per table at a time.

    For ``readings_raw``: ``log_hours`` notes the rooms and hours that get rows in
    ``hourly_stale``, for ``rollup.refresh_changed``; ``commit``, a name that a
    repeated batch bears again, adds what the rows come to per window to
    ``window_partials``. Both are written ahead of the rows, so that no row is
    stored without them.
    """
    spark = batch.sparkSession
    schema, _ = schemas.TABLES[table]
    path = f"{root}/{table}"
    keys = ["event_date", *(keys or UNIQUE_KEYS[table])]
    rows = batch.select(*dict.fromkeys([*schema.names, *order]))
    winners = first_wins(rows, keys, order).select(*schema.names).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        # One row per date, bounded by the calendar. Also fills the cache, so
        # that the joins below are planned on the batch's real size.
        time = schema.names[0]
        spans = winners.groupBy("event_date").agg(
            F.min(F.unix_micros(time)).alias("low"), F.max(F.unix_micros(time)).alias("high")).collect()
        if not spans:
            return
        stored = stored_near(spark, path, schema, time, spans).select(*keys)
        # Stored keys are first cut down to those of the batch, so a large day
        # is scanned but not shuffled when the batch is small.
        taken = stored.join(winners.select(*keys), keys, "left_semi")
        fresh = winners.join(taken, keys, "left_anti").select(*schema.names)
        if log_hours or commit:
            fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        if log_hours:
            fresh.select(F.date_trunc("hour", time).alias("bucket"), "room").distinct().coalesce(1).write.mode(
                "append").parquet(f"{root}/hourly_stale")
        if commit:
            append_partials(fresh, root, commit, [s["event_date"] for s in spans])
        fresh.hint("rebalance", F.col("event_date")).write.mode("append").partitionBy(
            "event_date").parquet(path)
        fresh.unpersist()
    finally:
        winners.unpersist()


def append_partials(rows: DataFrame, root: str, commit: str, dates: list[date]) -> None:
    """Add the partial windows of a commit's readings, unless they are there already.

    A commit that is repeated finds its name: in a repetition the rows it stored
    before no longer count as new, so what it wrote first must stay.
    """
    spark, path = rows.sparkSession, f"{root}/window_partials"
    stored = stored_dates(spark, path, schemas.WINDOW_PARTIALS, dates)
    if stored.filter(F.col("commit") == commit).isEmpty():
        rollup.partials(rows).withColumn("commit", F.lit(commit)).select(*schemas.WINDOW_PARTIALS.names).hint(
            "rebalance", F.col("event_date")).write.mode("append").partitionBy("event_date").parquet(path)


def fold_partials(spark: SparkSession, root: str, first: date, last: date) -> None:
    """Merge the partial windows of a range of dates into one row each.

    For dates whose commits are not repeated any more, while no writer works.
    """
    shared_root(spark)
    path = f"{root}/window_partials"
    rows = spark.read.schema(schemas.WINDOW_PARTIALS).parquet(path).filter(F.col("event_date").between(first, last))
    folded = rollup.merged(rows).withColumn("commit", F.lit(None).cast("string")).select(
        *schemas.WINDOW_PARTIALS.names).checkpoint()
    folded.hint("rebalance", F.col("event_date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def compact(spark: SparkSession, root: str, table: str, first: date, last: date) -> None:
    """Rewrite the date partitions of a range as few files.

    For closed dates, while no writer or stream works on the table: a stream
    reading it would take the new files for news.
    """
    shared_root(spark)
    schema, _ = schemas.TABLES[table]
    path = f"{root}/{table}"
    rows = spark.read.schema(schema).parquet(path).filter(
        F.col("event_date").between(first, last)).checkpoint()
    rows.hint("rebalance", F.col("event_date")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def alert_rows(alerts: DataFrame) -> DataFrame:
    """Alerts with the write time and an id that a replay reproduces."""
    start = F.timestamp_millis("window_start_ms")
    return alerts.select(
        F.xxhash64("room", start).alias("id"), "room", start.alias("window_start"),
        "max_temp", F.col("consecutive_count").cast("int").alias("consecutive_count"),
        F.current_timestamp().alias("time"), F.to_date(start).alias("event_date"))


def append_alerts(batch: DataFrame, root: str) -> None:
    """Append; a repeated micro-batch appends again, with the same ids."""
    alert_rows(batch).hint("rebalance", F.col("event_date")).write.mode("append").partitionBy(
        "event_date").parquet(f"{root}/alerts")


def append_jdbc(
    rows: DataFrame, url: str, table: str, batch_rows: int | None = None,
    driver: str = "org.postgresql.Driver", **options: str,
) -> None:
    """Append to a database table; the driver jar has to be on the class path."""
    rows.write.format("jdbc").options(
        url=url, dbtable=table, driver=driver, batchsize=batch_rows or BATCH_ROWS[table], **options,
    ).mode("append").save()
