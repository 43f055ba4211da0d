"""JSON messages to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.functions import scalar as S
from millpulse.schemas import EVENT

_CORRUPT = "_corrupt_record"
_EVENT_OR_CORRUPT = T.StructType(EVENT.fields + [T.StructField(_CORRUPT, T.StringType())])

REASONS = (
    "empty",
    "malformed_json",
    "bad_event_time",
    "missing_machine_id",
    "bad_field",
    "valid",
)


def parse_messages(messages: DataFrame, *keep: str) -> DataFrame:
    """The eight event fields of every message in ``value``; no row is dropped.

    Anything that cannot be read becomes NULL: a field that is missing or of the
    wrong type alone, or all fields when the text is no JSON object.
    """
    data = F.from_json(F.col("value").cast("string"), EVENT).alias("data")
    return messages.select(*keep, data).select(*keep, "data.*")


def classify_messages(messages: DataFrame, *keep: str) -> DataFrame:
    """The event fields plus ``raw`` text and ``reason`` (one of ``REASONS``)."""
    text = F.col("value").cast("string").alias("raw")
    data = F.from_json("raw", _EVENT_OR_CORRUPT, {"columnNameOfCorruptRecord": _CORRUPT})
    # As a one-element array expanded to columns, the parsed message is computed
    # exactly once: a filter on ``reason`` is not pushed below the expansion,
    # where it would parse the text again for every field it looks at.
    parsed = messages.select(*keep, text).select(*keep, "raw", F.inline(F.array(data)))
    return parsed.withColumn("reason", _reason()).drop(_CORRUPT)


def _reason() -> Column:
    raw, corrupt = F.col("raw"), F.col(_CORRUPT).isNotNull()
    is_object = F.json_object_keys(raw).isNotNull()
    return (
        F.when(raw.isNull() | (F.trim(raw) == ""), "empty")
        .when(corrupt & ~is_object, "malformed_json")
        .when(S.parse_timestamp(F.col("timestamp")).isNull(), "bad_event_time")
        .when(F.col("machine_id").isNull(), "missing_machine_id")
        .when(corrupt, "bad_field")
        .otherwise("valid")
    )


def valid_events(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason") == "valid").drop("raw", "reason")


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason") != "valid").select("raw", "reason")


def quarantine_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("reason").agg(F.count("*").alias("messages"))
