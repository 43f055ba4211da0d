"""Event fields to the 17-column reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.functions import scalar as S
from millpulse.schemas import READING


def derived_columns(naive_time: bool = False) -> dict[str, Column]:
    """The columns that follow from ``event_time`` and the measures."""
    bucket = S.bucket_start(F.col("event_time").cast("timestamp"))
    return {
        "date": F.to_date("event_time"),
        "hour": F.hour("event_time"),
        "temp_fahrenheit": S.to_fahrenheit(F.col("temperature_c")),
        "pressure_psi": S.to_psi(F.col("pressure_bar")),
        "is_fault": S.is_fault(F.col("fault_label")),
        "temp_status": S.temperature_band(F.col("temperature_c")),
        "time_window": bucket.cast("timestamp_ntz") if naive_time else bucket,
    }


def derive(readings: DataFrame) -> DataFrame:
    """Add the derived columns to rows that already carry ``event_time``."""
    naive = isinstance(readings.schema["event_time"].dataType, T.TimestampNTZType)
    return readings.withColumns(derived_columns(naive))


def enrich(events: DataFrame, *keep: str) -> DataFrame:
    """Parsed events to readings, in table column order.

    ``processing_time`` is fixed here, on the stream, and carried along: read
    again inside a batch callback it would be another instant.
    """
    timed = events.withColumns(
        {
            "event_time": S.parse_timestamp(F.col("timestamp")),
            "processing_time": F.current_timestamp(),
        }
    )
    return derive(timed).select(*keep, *READING.names)


def monitor_view(readings: DataFrame) -> DataFrame:
    """What the console monitor shows: a reading without its bookkeeping columns."""
    return readings.drop("processing_time", "time_window")
