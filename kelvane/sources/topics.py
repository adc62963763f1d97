"""Topics as streams of (key, value, partition, offset).

Spark keeps the read position in the checkpoint of each query, so independent
readers of one topic are just separate queries. Without a broker a topic is a
folder of Parquet files with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvane import schemas

# Topic names.
RAW_TOPIC = "raw-temperature"
WINDOW_TOPIC = "temperature-processed"
ALERT_TOPIC = "temperature-alerts"


def kafka_topic(
    spark: SparkSession, servers: str, topic: str,
    starting_offsets: str = "earliest", offsets_per_batch: int = 10_000_000, **options: str,
) -> DataFrame:
    """A topic from the earliest offset on, resuming from the checkpoint."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", offsets_per_batch)
        .options(**options)
        .load()
        .select("key", "value", "partition", "offset")
    )


def file_topic(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schemas.TOPIC).option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def text_topic(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed payloads, one JSON document per line, in the order files arrived.

    ``file`` and ``block`` place a line's block among those of one moment; the
    line's place in its block shows only where the rows are processed.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.unix_micros("_metadata.file_modification_time").alias("offset"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
