"""Tumbling-window metrics per machine.

One path serves batch and stream: a window is first reduced to parts that add
up (sums, counts, extremes) and turned into averages and percentages only at
the end. Parts from several micro-batches merge to exactly the metrics of all
their rows, and the map-side half of each aggregation leaves at most one row
per task, window and machine, so one busy machine does not load one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.functions import scalar as S
from millpulse.schemas import AGGREGATE_V1, METRIC

WINDOW_LENGTH = f"{S.WINDOW_MINUTES} minutes"
GROUP = ("window_start", "window_end", "machine_id")


def _parts() -> dict[str, Column]:
    return {
        "temperature_sum": F.sum("temperature_c"),
        "temperature_count": F.count("temperature_c"),
        "temperature_max": F.max("temperature_c"),
        "temperature_min": F.min("temperature_c"),
        "vibration_sum": F.sum("vibration_mms"),
        "vibration_count": F.count("vibration_mms"),
        "vibration_max": F.max("vibration_mms"),
        "pressure_sum": F.sum("pressure_bar"),
        "pressure_count": F.count("pressure_bar"),
        "fault_count": F.count_if("is_fault"),
        "total_readings": F.count("*"),
    }


def metric_partials(readings: DataFrame, length: str = WINDOW_LENGTH, *keys: str) -> DataFrame:
    """Mergeable parts per (window, machine), and per ``keys`` where given.

    Rows without an event time belong to no window.
    """
    parts = _parts()
    if "processing_time" in readings.columns:
        parts["processing_time"] = F.max("processing_time")
    grouped = readings.groupBy(F.window("event_time", length), "machine_id", *keys).agg(
        *[column.alias(name) for name, column in parts.items()]
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "machine_id",
        *keys,
        *parts,
    )


def _merge_rule(part: str) -> str:
    """The aggregate that merges a part across micro-batches."""
    if part.endswith("_max") or part == "processing_time":
        return "max"
    return "min" if part.endswith("_min") else "sum"


def _mean(measure: str) -> str:
    return f"CASE WHEN {measure}_count > 0 THEN {measure}_sum / {measure}_count END"


# Metric column -> expression over merged parts, for DataFrames and views alike.
_FINAL = {
    "avg_temperature": _mean("temperature"),
    "max_temperature": "temperature_max",
    "min_temperature": "temperature_min",
    "avg_vibration": _mean("vibration"),
    "max_vibration": "vibration_max",
    "avg_pressure": _mean("pressure"),
    "fault_percentage": "fault_count * 100.0D / total_readings",
}


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row of parts per (window, machine), however many there were."""
    names = [*_parts(), *(["processing_time"] if "processing_time" in partials.columns else [])]
    merged = [F.expr(f"{_merge_rule(name)}({name})").alias(name) for name in names]
    return partials.groupBy(*GROUP).agg(*merged)


def newest_states(states: DataFrame) -> DataFrame:
    """Of each stream the newest state of each window: states replace each other."""
    own = [c for c in states.columns if c not in (*GROUP, "stream_id")]
    newest = states.groupBy("stream_id", *GROUP).agg(F.max_by(F.struct(*own), "batch_id").alias("state"))
    return newest.select("stream_id", *GROUP, "state.*")


def finish(partials: DataFrame) -> DataFrame:
    """Parts, one row per (window, machine), to the metric columns. No shuffle."""
    present = [n for n in METRIC.names if n in _FINAL or n in partials.columns]
    return partials.select(*[F.expr(_FINAL.get(n, n)).alias(n) for n in present])


def merge_sql(source: str) -> str:
    """``finish(merge_partials(...))`` of a stored table as SQL text, for views."""
    parts = ", ".join(f"{_merge_rule(n)}({n}) AS {n}" for n in [*_parts(), "processing_time"])
    merged = f"SELECT {', '.join(GROUP)}, {parts} FROM {source} GROUP BY {', '.join(GROUP)}"
    return f"SELECT {', '.join(f'{_FINAL.get(n, n)} AS {n}' for n in METRIC.names)} FROM ({merged})"


def states_sql(source: str) -> str:
    """``merge_sql`` over the newest states of a stored table of window states."""
    parts, group = ", ".join([*_parts(), "processing_time"]), ", ".join(GROUP)
    newest = f"SELECT {group}, max_by(struct({parts}), batch_id) AS state FROM {source} GROUP BY stream_id, {group}"
    return merge_sql(f"(SELECT {group}, state.* FROM ({newest}))")


def window_metrics(readings: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Metrics of all ``readings``, one row per (window, machine), one shuffle."""
    return finish(metric_partials(readings, length))


def merged_window_metrics(partials: DataFrame) -> DataFrame:
    return finish(merge_partials(partials))


def struct_window_aggregates(readings: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """The older aggregate form: the window stays a struct, counts are int."""
    metrics = window_metrics(readings, length)
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    special = {
        "window": window,
        "fault_count": F.col("fault_count").cast("int"),
        "reading_count": F.col("total_readings").cast("int"),
    }
    return metrics.select(
        *[special[n].alias(n) if n in special else F.col(n) for n in AGGREGATE_V1.names]
    )
