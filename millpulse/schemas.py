"""Table and message schemas. Every column is nullable.

Fixed values: the column names, their order and their types are the data
contract that existing producers, tables and reports rely on.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


_MEASURES = (
    ("vibration_mms", "double"),
    ("temperature_c", "double"),
    ("pressure_bar", "double"),
    ("rms_vibration", "double"),
    ("mean_temp", "double"),
    ("fault_label", "int"),
)

# CSV header -> message field.
CSV_COLUMNS: dict[str, str] = {
    "Timestamp": "timestamp",
    "Vibration (mm/s)": "vibration_mms",
    "Temperature (°C)": "temperature_c",
    "Pressure (bar)": "pressure_bar",
    "RMS Vibration": "rms_vibration",
    "Mean Temp": "mean_temp",
    "Fault Label": "fault_label",
}

# All cells are read as text: one bad cell must not change the type of a column.
CSV_ROWS = _struct(*((name, "string") for name in CSV_COLUMNS))

EVENT = _struct(("timestamp", "string"), ("machine_id", "string"), *_MEASURES)

READING_V1 = _struct(
    ("timestamp", "string"),
    ("machine_id", "string"),
    *_MEASURES,
    ("event_time", "timestamp"),
    ("date", "date"),
    ("hour", "int"),
    ("temp_fahrenheit", "double"),
    ("pressure_psi", "double"),
    ("is_fault", "boolean"),
)

READING = T.StructType(
    READING_V1.fields
    + _struct(
        ("temp_status", "string"),
        ("processing_time", "timestamp"),
        ("time_window", "timestamp"),
    ).fields
)

_STATISTICS = (
    ("avg_temperature", "double"),
    ("max_temperature", "double"),
    ("min_temperature", "double"),
    ("avg_vibration", "double"),
    ("max_vibration", "double"),
    ("avg_pressure", "double"),
)

METRIC = _struct(
    ("window_start", "timestamp"),
    ("window_end", "timestamp"),
    ("machine_id", "string"),
    *_STATISTICS,
    ("fault_count", "bigint"),
    ("total_readings", "bigint"),
    ("fault_percentage", "double"),
    ("processing_time", "timestamp"),
)

AGGREGATE_V1 = T.StructType(
    [
        T.StructField("window", _struct(("start", "timestamp"), ("end", "timestamp")), True),
        *_struct(
            ("machine_id", "string"),
            *_STATISTICS,
            ("fault_count", "int"),
            ("reading_count", "int"),
        ).fields,
    ]
)

# Own storage form: what one micro-batch knows about a (window, machine), kept
# in a shape that adds up across micro-batches.
METRIC_PARTIAL = _struct(
    ("window_start", "timestamp"),
    ("window_end", "timestamp"),
    ("machine_id", "string"),
    ("temperature_sum", "double"),
    ("temperature_count", "bigint"),
    ("temperature_max", "double"),
    ("temperature_min", "double"),
    ("vibration_sum", "double"),
    ("vibration_count", "bigint"),
    ("vibration_max", "double"),
    ("pressure_sum", "double"),
    ("pressure_count", "bigint"),
    ("fault_count", "bigint"),
    ("total_readings", "bigint"),
    ("processing_time", "timestamp"),
    ("window_date", "date"),
)

QUARANTINE = _struct(
    ("raw", "string"),
    ("reason", "string"),
    ("processing_time", "timestamp"),
    ("quarantine_date", "date"),
)

# What became of the messages of one micro-batch.
AUDIT = _struct(
    ("offered", "bigint"),
    ("readings", "bigint"),
    ("timed_readings", "bigint"),
    ("quarantined", "bigint"),
    ("audit_date", "date"),
)


# Who wrote a row: the stream (its checkpoint's id) and the micro-batch.
BATCH_KEY = ("stream_id", "batch_id")


def with_batch_key(schema: T.StructType) -> T.StructType:
    """The stored form of a table that is written one micro-batch at a time."""
    return T.StructType(schema.fields + _struct(("stream_id", "string"), ("batch_id", "bigint")).fields)
