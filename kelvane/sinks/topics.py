"""Topic writers: broker or, with the same rows, a folder of files.

Messages are (key, value, ordinal). All messages of a key go to one topic
partition, in the order of ``ordinal``. A repeated micro-batch publishes its
messages again, as a broker without transactions does.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TopicWriter = Callable[[DataFrame], None]


def in_order(messages: DataFrame, by: str, partitions: int | None = None) -> DataFrame:
    """Messages of one ``by`` in one task, sorted."""
    together = messages.repartition(partitions, by) if partitions else messages.repartition(by)
    return together.sortWithinPartitions(by, "key", "ordinal", "value")


def kafka_writer(servers: str, topic: str, **options: str) -> TopicWriter:
    def write(messages: DataFrame) -> None:
        in_order(messages, "key").select("key", "value").write.format("kafka").option(
            "kafka.bootstrap.servers", servers).option("topic", topic).options(**options).save()
    return write


def file_writer(path: str, partitions: int = 6) -> TopicWriter:
    """A folder with the columns of a topic; one writer at a time.

    A topic partition lies in one file per commit, so no cut between files can
    part the messages of a room. Offsets grow within a partition and from one
    commit to the next: the time of the commit, then the place in it.
    """
    def write(messages: DataFrame) -> None:
        placed = messages.withColumn(
            "partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
        start = time.time_ns() // 1_000_000 << 22
        row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        in_order(placed, "partition", partitions).select(
            "key", F.col("value").cast("binary").alias("value"), "partition",
            (F.lit(start) + row).alias("offset")).write.mode("append").parquet(path)
    return write
