"""Continuous window metrics with a bound on late data."""

from __future__ import annotations

import logging
import threading
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millpulse.operators.metrics import WINDOW_LENGTH, finish, merge_partials, metric_partials, newest_states
from millpulse.session import setting
from millpulse.sinks.batch_tables import BatchId, BatchTable
from millpulse.streaming.ingest import durable_stream_id

log = logging.getLogger(__name__)

LATE_BOUND = "10 minutes"
_STARTING = threading.Lock()


class LateRows(StreamingQueryListener):
    """Reports rows that came too late for their window; they are in no metric."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryProgress(self, event) -> None:
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        if late:
            key = str(event.progress.id)
            self.dropped[key] = self.dropped.get(key, 0) + late
            log.warning(
                "query %s, batch %d: %d groups of rows came after their window had closed",
                event.progress.name or key, event.progress.batchId, late,
            )

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def windowed_stream(
    readings: DataFrame, delay: str = LATE_BOUND, length: str = WINDOW_LENGTH
) -> DataFrame:
    """Window parts kept as stream state until the watermark passes the window.

    ``event_time`` must be a TIMESTAMP. State holds one row per open window and
    machine, and rows more than ``delay`` behind are left out; ``LateRows`` tells
    how many.
    """
    return metric_partials(readings.withWatermark("event_time", delay), length)


def start_windowed(
    readings: DataFrame,
    target: BatchTable,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    delay: str = LATE_BOUND,
    length: str = WINDOW_LENGTH,
    output_mode: str = "update",
    state_partitions: int | None = None,
    stream_id: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Store window states as they change (``update``) or once closed (``append``).

    Only changed windows are written in each step, never the whole result.

    The first start fixes the number of state partitions for the life of the
    checkpoint: ``state_partitions``, or the session's shuffle partitions. About
    one per core of the cluster is a good choice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # One row per changed window, but spread over all state partitions.
        key = BatchId(stream_id or durable_stream_id(batch), batch_id)
        target.replace_batch(
            batch.withColumn("window_date", F.to_date("window_start")), key, rebalance=True
        )

    writer = (
        windowed_stream(readings, delay, length)
        .writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if state_partitions is None:
        return writer.start()
    # A query takes a copy of the session settings when it starts. One start at a
    # time, or another one could take this number too.
    with _STARTING, setting(
        readings.sparkSession, "spark.sql.shuffle.partitions", str(state_partitions)
    ):
        return writer.start()


def latest_windows(states: DataFrame) -> DataFrame:
    """Final metrics from stored window states: of each stream the newest state of
    each window, and the streams merged."""
    return finish(merge_partials(newest_states(states)))
