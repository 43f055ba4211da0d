"""Message stream to tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from millpulse.operators.enrich import enrich
from millpulse.operators.metrics import WINDOW_LENGTH, metric_partials
from millpulse.operators.parse import classify_messages, parse_messages
from millpulse.schemas import AUDIT
from millpulse.sinks.batch_tables import BatchId, BatchTable

log = logging.getLogger(__name__)

TABLE_TRIGGER = {"processingTime": "30 seconds"}


@dataclass(frozen=True)
class IngestTargets:
    """Where the rows of a micro-batch go.

    Without a quarantine table every message becomes a reading, however little
    of it could be read. With one, only valid messages do. An audit table gets a row
    for each micro-batch: messages offered, stored as readings, quarantined.
    """

    readings: BatchTable
    partials: BatchTable
    quarantine: BatchTable | None = None
    audit: BatchTable | None = None


@dataclass(frozen=True)
class BatchReport:
    batch_id: int
    readings: int
    timed_readings: int


def log_report(report: BatchReport) -> None:
    log.info(
        "batch %d: %d readings, %d with an event time",
        report.batch_id, report.readings, report.timed_readings,
    )


def durable_stream_id(batch: DataFrame) -> str:
    """The id that a checkpoint gives its query: the same after every restart,
    another one under another checkpoint. Known inside ``foreachBatch`` only."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream:
        raise RuntimeError("not inside a streaming query: state the stream id")
    return stream


def enriched_stream(messages: DataFrame) -> DataFrame:
    return enrich(parse_messages(messages))


def classified_stream(messages: DataFrame) -> DataFrame:
    return enrich(classify_messages(messages), "raw", "reason")


def batch_writer(
    targets: IngestTargets,
    on_batch: Callable[[BatchReport], None] = log_report,
    length: str = WINDOW_LENGTH,
    backfill: bool = False,
    stream_id: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one micro-batch to all tables.

    The batch is kept (memory, then disk) because several tables are written
    from it; the source is read and parsed once. Row counts are observed while
    the readings are written, so counting costs no job. An error is not caught:
    the query stops, the batch stays uncommitted, and the next start writes it
    again over whatever was left behind.

    ``backfill`` brings readings together by day before they are written, for
    batches that hold many days at once. ``stream_id`` names the writer in the
    tables; by default the id of the checkpoint does.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        key = BatchId(stream_id or durable_stream_id(batch), batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            offered = Observation()
            # The time of processing is that of the batch, also when it runs again.
            counts = [F.count("*").alias("offered"), F.max(F.to_date("processing_time")).alias("day")]
            if targets.quarantine is not None:
                counts.append(F.count_if(F.col("reason") != "valid").alias("quarantined"))
            everything = batch.observe(offered, *counts)
            valid = everything
            if targets.quarantine is not None:
                valid = everything.filter(F.col("reason") == "valid")
            seen = Observation()
            counted = valid.observe(
                seen,
                F.count("*").alias("readings"),
                F.count("event_time").alias("timed"),
            )
            targets.readings.replace_batch(counted, key, rebalance=backfill)
            readings, timed = seen.get["readings"], seen.get["timed"]

            # Without an event time there is no window, hence nothing to write.
            if timed > 0:
                kept = batch if targets.quarantine is None else batch.filter(F.col("reason") == "valid")
                partials = metric_partials(kept, length)
                targets.partials.replace_batch(
                    partials.withColumn("window_date", F.to_date("window_start")),
                    key,
                    rebalance=True,
                )
            if targets.quarantine is not None:
                rejected = batch.filter(F.col("reason") != "valid").withColumn(
                    "quarantine_date", F.to_date("processing_time")
                )
                targets.quarantine.replace_batch(rejected, key)
            found = offered.get
            if targets.audit is not None and found["offered"] > 0:
                # Last: a batch that has its row here is in all other tables.
                row = (found["offered"], readings, timed, found.get("quarantined", 0), found["day"])
                targets.audit.replace_batch(batch.sparkSession.createDataFrame([row], AUDIT), key)
            on_batch(BatchReport(batch_id, readings, timed))
        finally:
            batch.unpersist()

    return write


def start_ingest(
    messages: DataFrame,
    targets: IngestTargets,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    on_batch: Callable[[BatchReport], None] = log_report,
    name: str | None = None,
    backfill: bool = False,
    stream_id: str | None = None,
) -> StreamingQuery:
    """Parse, enrich and store a message stream. ``checkpoint`` must be durable."""
    stream = (
        enriched_stream(messages) if targets.quarantine is None else classified_stream(messages)
    )
    writer = (
        stream.writeStream.foreachBatch(
            batch_writer(targets, on_batch, backfill=backfill, stream_id=stream_id)
        )
        .outputMode("append")
        .trigger(**(trigger or TABLE_TRIGGER))
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()


def await_any(spark: SparkSession) -> None:
    """Block until one of several queries ends; a failed one raises here."""
    spark.streams.awaitAnyTermination()
