"""The reports: readings or metrics in, result out.

Each selects only the columns it needs and filters on stored columns, so
projection and predicates reach the file scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.functions import scalar as S

# Limits used by the reports.
RISK_VIBRATION_MMS = 8.0
RISK_PRESSURE_BAR = 2.5
RISK_BAND = "HIGH"
RECENT_LIMIT = 50
FAULT_PERCENTAGE_LIMIT = 10
TREND_DAYS = 7


def temperature_trend(readings: DataFrame) -> DataFrame:
    """Every known temperature in time order.

    The row number ends the sort key: rows that share time and machine (copies
    of one reading may be a large part of the table) then still spread over
    many range partitions instead of meeting in one task.
    """
    known = readings.filter(
        F.col("event_time").isNotNull() & F.col("temperature_c").isNotNull()
    ).select("machine_id", "event_time", "temperature_c")
    return (
        known.withColumn("_row", F.monotonically_increasing_id())
        .orderBy("event_time", "machine_id", "_row")
        .drop("_row")
    )


def fault_by_machine(readings: DataFrame) -> DataFrame:
    """Readings, faults and fault percentage (two decimals, half up) per machine."""
    counted = readings.groupBy("machine_id").agg(
        F.count("*").alias("total_readings"),
        F.count_if("is_fault").alias("fault_count"),
    )
    # Decimal arithmetic: the half-up rounding sees the exact quotient.
    rate = F.round(
        F.col("fault_count") * F.lit(100.0).cast("decimal(4,1)") / F.col("total_readings"), 2
    )
    return counted.withColumn("fault_percentage", rate.cast("double")).orderBy(
        F.desc("fault_percentage"), "machine_id"
    )


def hourly_patterns(readings: DataFrame) -> DataFrame:
    """Average measures, readings and faults per hour of day."""
    return (
        readings.groupBy("hour")
        .agg(
            F.avg("temperature_c").alias("avg_temperature"),
            F.avg("vibration_mms").alias("avg_vibration"),
            F.avg("pressure_bar").alias("avg_pressure"),
            F.count("*").alias("reading_count"),
            F.count_if("is_fault").alias("fault_count"),
        )
        .orderBy("hour")
    )


def recent_high_risk(
    readings: DataFrame, limit: int = RECENT_LIMIT, include_faults: bool = False
) -> DataFrame:
    """The latest readings that are hot, shaking or under pressure.

    ``include_faults`` also takes readings whose only mark is a fault.
    """
    risky = (
        (F.col("temp_status") == RISK_BAND)
        | (F.col("vibration_mms") > RISK_VIBRATION_MMS)
        | (F.col("pressure_bar") > RISK_PRESSURE_BAR)
    )
    if include_faults:
        risky = risky | F.col("is_fault")
    shown = readings.filter(risky).select(
        "event_time",
        "machine_id",
        "temperature_c",
        "vibration_mms",
        "pressure_bar",
        "temp_status",
        "is_fault",
    )
    ties = [c for c in shown.columns if c != "event_time"]
    return shown.orderBy(F.desc("event_time"), *ties).limit(limit)


def recent_risk_or_fault(readings: DataFrame, limit: int = RECENT_LIMIT) -> DataFrame:
    return recent_high_risk(readings, limit, include_faults=True)


#: How many times more days are read when the newest ones held too few rows.
WIDER = 4


def newest_first(
    days: Iterable[dt.date],
    read: Callable[[dt.date, dt.date], DataFrame],
    pick: Callable[[DataFrame], DataFrame],
    limit: int,
    time: str = "event_time",
) -> DataFrame:
    """``pick`` of a table by days, reading as few of the newest days as it takes.

    ``days`` are all the days that have rows, ``read`` gives the rows of [since,
    until) and those without a day, ``pick`` orders by ``time``, newest first, and
    takes ``limit`` rows. The newest day is read, then four, sixteen and so on,
    until so many rows with a time are found that no older day can have a better
    one. In the worst case, when such rows are rare, days are read by a third more
    than once.
    """
    known = sorted(set(days), reverse=True)
    if not known:
        return pick(read(dt.date.min, dt.date.min))
    until, n = known[0] + dt.timedelta(days=1), 1
    while True:
        rows = pick(read(known[min(n, len(known)) - 1], until))
        if n >= len(known) or rows.filter(F.col(time).isNotNull()).count() >= limit:
            return rows
        n *= WIDER


def high_fault_windows(
    metrics: DataFrame, threshold: float = FAULT_PERCENTAGE_LIMIT
) -> DataFrame:
    """Windows above a fault percentage, newest and worst first."""
    return (
        metrics.filter(F.col("fault_percentage") > threshold)
        .select(
            "machine_id",
            "window_start",
            "window_end",
            "avg_temperature",
            "max_vibration",
            "fault_percentage",
            "total_readings",
        )
        .orderBy(F.desc("window_start"), F.desc("fault_percentage"), "machine_id")
    )


def daily_temperature_stats(
    readings: DataFrame, days: int = TREND_DAYS, as_of: dt.datetime | None = None
) -> DataFrame:
    """Temperature per day and machine over the trailing ``days``.

    The span ends at ``as_of``, or at the latest event time in the data: the
    latest day first (of a stored table, folder names only), then the latest time
    within it. ``date`` is bounded on both sides too, so other partitions of a
    stored table are not read.
    """
    if as_of is None:
        day = readings.agg(F.max("date").alias("day")).scalar()
        until = readings.filter(F.col("date") == day).agg(F.max("event_time").alias("latest")).scalar()
    else:
        until = S.instant(as_of)
    since = until - F.make_dt_interval(F.lit(days))
    recent = readings.filter(
        (F.col("event_time") >= since) & (F.col("event_time") <= until)
        & (F.col("date") >= F.to_date(since)) & (F.col("date") <= F.to_date(until))
    )
    return (
        recent.groupBy("date", "machine_id")
        .agg(
            F.avg("temperature_c").alias("avg_temperature"),
            F.max("temperature_c").alias("max_temperature"),
            F.min("temperature_c").alias("min_temperature"),
            F.count("temperature_c").alias("reading_count"),
        )
        .orderBy(F.desc("date"), "machine_id")
    )


def sample_readings(readings: DataFrame, *order: str, n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order; distributed files have none of their own."""
    return readings.orderBy(*order).limit(n)
