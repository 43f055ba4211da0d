"""Sensor readings taken from a generic ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` carries no sensor
columns of its own; this mapping gives every event a machine and measures, so
that the operators can run on (and be checked against) any such table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    # Streaming reads accept a plain path only for a folder; a pattern also
    # matches a table that is one single file.
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/events.parque[t]")


def event_fields(events: DataFrame) -> DataFrame:
    """``event_id``, ``event_time`` and the eight message fields."""
    return events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.concat(F.lit("machine_"), (F.col("user_id") % 10 + 1).cast("string")).alias("machine_id"),
        ((F.col("event_id") % 120) / F.lit(10.0)).alias("vibration_mms"),
        F.col("value").alias("temperature_c"),
        (F.from_json("props", "k int")["k"] / F.lit(33.0)).alias("pressure_bar"),
        ((F.col("event_id") % 120) / F.lit(10.0) * F.lit(0.5)).alias("rms_vibration"),
        F.col("value").alias("mean_temp"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("fault_label"),
    )


def csv_cells(events: DataFrame, bad_every: int = 0) -> DataFrame:
    """The events as CSV text cells under the CSV header names, plus ``event_id``.

    With ``bad_every`` each such event gets a temperature that is no number.
    """
    fields = event_fields(events)
    temperature = F.col("temperature_c").cast("string")
    if bad_every:
        temperature = F.when(F.col("event_id") % bad_every == 0, "n/a").otherwise(temperature)
    return fields.select(
        "event_id",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"),
        F.col("vibration_mms").cast("string").alias("Vibration (mm/s)"),
        temperature.alias("Temperature (°C)"),
        F.col("pressure_bar").cast("string").alias("Pressure (bar)"),
        F.col("rms_vibration").cast("string").alias("RMS Vibration"),
        F.col("mean_temp").cast("string").alias("Mean Temp"),
        F.col("fault_label").cast("string").alias("Fault Label"),
    )


def damaged_messages(events: DataFrame) -> DataFrame:
    """Messages of which one in fifty each is broken in one of four ways."""
    good = F.to_json(
        F.struct(
            "timestamp", "machine_id", "vibration_mms", "temperature_c",
            "pressure_bar", "rms_vibration", "mean_temp", "fault_label",
        )
    )
    kind = F.col("event_id") % 50
    value = (
        F.when(kind == 0, "not json")
        .when(kind == 1, '{"probe":true,"timestamp":"2024-02-03T04:05:06"}')
        .when(kind == 2, F.to_json(F.struct(F.lit("garbage").alias("timestamp"), "machine_id")))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(good)
    )
    return event_fields(events).select("event_id", value.cast("binary").alias("value"))
