"""The jobs: raw sink, window aggregation, alert detection, payload intake.

Each is one streaming query with its own checkpoint, hence an independent
reader of its source. A repeated micro-batch leaves the stored readings and
windows, rejects and ticks as they are; alerts and topic messages come twice.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.storagelevel import StorageLevel

from kelvane.operators import batch as batches
from kelvane.operators import codec, metrics, payload, windows
from kelvane.operators.alerts import CONSECUTIVE_THRESHOLD, MAX_TEMP_THRESHOLD
from kelvane.session import SINGLE_STATEFUL_SETTINGS, STATE_SETTINGS, conf_scope
from kelvane.sinks import tables
from kelvane.sinks.topics import TopicWriter
from kelvane.sources import otlp
from kelvane.streaming.clocks import live_snapshots, tumble_by_partition
from kelvane.streaming.detector import stream_alerts

log = logging.getLogger(__name__)

# Fixed value: the checkpoint interval of all jobs.
EVERY_MINUTE = {"processingTime": "60 seconds"}

ARRIVAL_ORDER = ["partition", "offset", "position"]


def readings_of_batches(
    topic: DataFrame, mode: str = "first", missing: str = "zero", native: bool = True,
) -> DataFrame:
    """Readings of a topic of metric batches, with their arrival order.

    Batches are bytes or, in ``resource_metrics``, decoded already. ``native``
    decodes bytes by ``from_protobuf``, which needs the Spark protobuf module.
    """
    decoded = topic.drop("key")
    if "resource_metrics" not in topic.columns:
        decoded = otlp.decode_batches(decoded, native=native)
    return batches.flatten_batches(decoded, mode, missing, keep=("partition", "offset"))


def windows_of_messages(topic: DataFrame) -> DataFrame:
    """Window results of their topic, with their place in it."""
    return codec.read_messages(topic, keep=("partition", "offset"))


def readings_of_payloads(topic: DataFrame) -> DataFrame:
    """Good readings of a topic of JSON payloads, with their arrival order."""
    order = F.struct("file", "block") if "file" in topic.columns else F.lit(0)
    placed = topic.drop("key")
    if "position" not in topic.columns:
        placed = placed.withColumn("position", order)
    return payload.accepted(payload.parse_payloads(placed), keep=tuple(ARRIVAL_ORDER))


def positioned(batch: DataFrame) -> DataFrame:
    """The place of each row of a micro-batch among those with its offset.

    Landed lines share the time of their file: file, block and the line's place
    in the block, in which a task reads them, follow. Offsets of a broker are
    unique.
    """
    rows = batch.drop("key")
    if "file" not in rows.columns:
        return rows.withColumn("position", F.lit(0))
    line = F.monotonically_increasing_id()
    return rows.withColumn("position", F.struct("file", "block", line.alias("line"))).drop("file", "block")


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query a micro-batch belongs to; a new checkpoint gives a new one."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("the id of the streaming query is not known here")
    return query


def batch_folder(batch: DataFrame, root: str, batch_id: int) -> str:
    """A folder of this query and micro-batch: written anew when it repeats.

    Batches count from 0 again under a new checkpoint, but the query has a new id.
    """
    return f"{root}/query={query_id(batch)}/batch={batch_id}"


def timer_settings(trigger: dict | None) -> dict[str, str]:
    """For state with timers: a run over what is there ends with its data, as
    micro-batches without data would go on for ever."""
    ends = bool(trigger) and ("availableNow" in trigger or "once" in trigger)
    return STATE_SETTINGS | {"spark.sql.streaming.noDataMicroBatches.enabled": str(not ends).lower()}


def with_date(readings: DataFrame) -> DataFrame:
    return readings.withColumn("event_date", F.to_date("time"))


def start_raw_job(
    readings: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
    order: list[str] | None = None, log_hours: bool = False, partials: bool = False,
) -> StreamingQuery:
    """Store every reading once. No watermark: late readings are stored too.

    ``log_hours`` and ``partials`` keep what ``rollup.refresh_changed`` and the
    products of partial windows need.
    """
    order = order or ARRIVAL_ORDER

    def write(batch: DataFrame, batch_id: int) -> None:
        commit = f"{query_id(batch)}/{batch_id}" if partials else None
        tables.insert_first_wins(batch, root, "readings_raw", order, log_hours=log_hours, commit=commit)

    return (
        with_date(readings).writeStream.queryName("raw")
        .foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE)).start()
    )


def start_window_job(
    readings: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
    width: str = "5 minutes", watermark: str = "10 seconds", topic: TopicWriter | None = None,
    by_partition: bool = False, idle: str = "1 minute", partitions: tuple[int, ...] = (),
) -> StreamingQuery:
    """Store each closed window once and publish it.

    ``by_partition`` keeps a watermark for each source partition, of which the
    least closes windows; see ``tumble_by_partition`` for ``idle`` and ``partitions``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        closed = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables.insert_first_wins(
                windows.as_table_rows(closed), root, "readings_aggregated", ["bucket"])
            if topic:
                topic(codec.window_messages(closed))
        finally:
            closed.unpersist()

    if by_partition:
        closed, settings = tumble_by_partition(readings, width, watermark, idle, partitions), timer_settings(trigger)
    else:
        closed, settings = windows.tumble(readings, width, watermark), SINGLE_STATEFUL_SETTINGS
    closed = closed.observe("windows", F.count_if(F.col("room").isNull()).alias("unpublished"))
    with conf_scope(readings.sparkSession, settings):
        return (
            closed.writeStream.queryName("windows").outputMode("append")
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_MINUTE)).start()
        )


def start_alert_job(
    window_results: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
    threshold: float = MAX_TEMP_THRESHOLD, consecutive: int = CONSECUTIVE_THRESHOLD,
    topic: TopicWriter | None = None, gap_resets: bool = False, dedupe: bool = False,
    runs: DataFrame | None = None,
) -> StreamingQuery:
    """Store and publish alerts of window results, best read from their topic.

    ``runs`` are the runs to go on from under a new checkpoint, by
    ``alerts.run_state`` or ``detector.stored_runs``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        raised = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables.append_alerts(raised, root)
            if topic:
                topic(codec.alert_messages(raised))
        finally:
            raised.unpersist()

    with conf_scope(window_results.sparkSession, STATE_SETTINGS):
        return (
            stream_alerts(window_results, threshold, consecutive, gap_resets, dedupe, runs=runs)
            .writeStream.queryName("alerts").outputMode("append")
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or EVERY_MINUTE)).start()
        )


class OutcomeCounts(StreamingQueryListener):
    """Hands on the numbers of accepted and rejected payloads of each micro-batch.

    They come with the progress of the query that observes them, so no job counts
    again what has been decoded.
    """

    def __init__(self, tell: Callable[[int, int, int], None]) -> None:
        self.tell, self.query = tell, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get("payloads")
        if counts is not None and (self.query is None or str(progress.id) == self.query):
            self.tell(progress.batchId, counts["accepted"], counts["rejected"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _log_outcomes(batch: int, accepted: int, rejected: int) -> None:
    log.info("batch %d: %d payloads accepted, %d rejected", batch, accepted, rejected)


def start_payload_job(
    topic: DataFrame, root: str, rejects: str, checkpoint: str, trigger: dict | None = None,
    outcomes: Callable[[int, int, int], None] = _log_outcomes,
) -> StreamingQuery:
    """Decode payloads, store the good readings and keep the bad with a reason.

    ``outcomes`` gets the number of each micro-batch, of its accepted and of its
    rejected payloads; by default they are logged.
    """
    # Lines of Spark's text source find their place only where they are processed.
    in_stream = "file" not in topic.columns
    rows = topic
    if in_stream:
        rows = rows.drop("key") if "position" in rows.columns else rows.drop("key").withColumn("position", F.lit(0))
        rows = payload.count_outcomes(payload.parse_payloads(rows))

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = batch if in_stream else payload.parse_payloads(positioned(batch))
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = payload.accepted(parsed, keep=tuple(ARRIVAL_ORDER))
            tables.insert_first_wins(with_date(good), root, "readings_raw", ARRIVAL_ORDER)
            # A repeated batch replaces its own rejects.
            payload.rejected(parsed, keep=("partition", "offset")).write.mode(
                "overwrite").parquet(batch_folder(batch, rejects, batch_id))
            if not in_stream:
                bad = F.col("reject_reason").isNotNull()
                outcomes(batch_id, *parsed.agg(F.count_if(~bad), F.count_if(bad)).first())
        finally:
            parsed.unpersist()

    listener = OutcomeCounts(outcomes)
    if in_stream:
        topic.sparkSession.streams.addListener(listener)
    query = (
        rows.writeStream.queryName("payloads")
        .foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_MINUTE)).start()
    )
    listener.query = str(query.id)
    return query


def start_snapshot_job(
    readings: DataFrame, ticks: str, checkpoint: str,
    arrival: tuple[str, ...] = ("arrival",), trigger: dict | None = None,
) -> StreamingQuery:
    """Write the whole latest-value snapshot at every trigger with news as one tick.

    Spark starts no batch without news, so these ticks stop while all sensors are
    silent; those of ``start_tick_job`` do not.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("tick", F.current_timestamp()).write.mode("overwrite").parquet(
            batch_folder(batch, ticks, batch_id))

    return (
        metrics.latest_snapshot(readings, arrival).writeStream.queryName("snapshot")
        .outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    )


def start_tick_job(
    readings: DataFrame, ticks: str, checkpoint: str, period: str = "10 seconds",
    arrival: tuple[str, ...] = ("arrival",), trigger: dict | None = None,
) -> StreamingQuery:
    """Write the latest values of every sensor once a period, whether it has news or not."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(batch, ticks, batch_id))

    with conf_scope(readings.sparkSession, timer_settings(trigger)):
        return (
            live_snapshots(readings, period, arrival).writeStream.queryName("ticks").outputMode("append")
            .foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": period})).start()
        )
