"""Scans of the stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane import schemas


def scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A stored table with its declared schema; dates prune to partitions."""
    schema, _ = schemas.TABLES[table]
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def stored_dates(spark: SparkSession, path: str, schema, dates: list[date]) -> DataFrame:
    """Stored rows of these dates; other partitions are not even listed."""
    listed = ",".join(map(str, dates))
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/event_date={{{listed}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored_near(spark: SparkSession, path: str, schema, time: str, spans: list) -> DataFrame:
    """Stored rows within the time span of each date, listing only those dates.

    Literal bounds reach the scan, so row groups outside them are skipped: a
    small batch does not read the keys of its whole day.
    """
    stored = stored_dates(spark, path, schema, [s["event_date"] for s in spans])
    near = [(F.col("event_date") == F.lit(s["event_date"]))
            & F.col(time).between(F.timestamp_micros(F.lit(s["low"])), F.timestamp_micros(F.lit(s["high"])))
            for s in spans]
    while len(near) > 1:  # a balanced tree: many dates make no deep expression
        near = [near[i] | near[i + 1] if i + 1 < len(near) else near[i] for i in range(0, len(near), 2)]
    return stored.filter(near[0])


def scan_stream(spark: SparkSession, root: str, table: str, files_per_batch: int = 1000) -> DataFrame:
    """A stored table as a stream of its appended files, in no order of time."""
    schema, _ = schemas.TABLES[table]
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .parquet(f"{root}/{table}")
    )


def scan_jdbc(
    spark: SparkSession, url: str, table: str, driver: str = "org.postgresql.Driver",
    partition_column: str | None = None, bounds: tuple[str, str] | None = None,
    partitions: int = 32, **options: str,
) -> DataFrame:
    """The same tables in a database; the driver jar has to be on the class path.

    With ``partition_column`` and ``bounds`` the read is split into ranges.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, driver=driver, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
            numPartitions=partitions)
    return reader.load()
