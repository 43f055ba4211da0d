"""Watching a stream on the console."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

MONITOR_TRIGGER = {"processingTime": "10 seconds"}
FAST_TRIGGER = {"processingTime": "5 seconds"}
SHOWN_ROWS = 20


def start_monitor(
    readings: DataFrame,
    trigger: dict[str, Any] | None = None,
    name: str | None = None,
    checkpoint: str | None = None,
    rows: int = SHOWN_ROWS,
) -> StreamingQuery:
    """Print the first new readings of each step in full width. Reads the source
    on its own.

    At most ``rows`` + 1 rows of a step are computed for the driver. The console
    sink of Spark itself would bring the whole step there.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"step {batch_id}")
        batch.show(rows, truncate=False)

    writer = (
        readings.writeStream.foreachBatch(show)
        .outputMode("append")
        .trigger(**(trigger or MONITOR_TRIGGER))
    )
    if name:
        writer = writer.queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()
