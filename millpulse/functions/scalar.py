"""Column expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, conversion factors and labels of the data contract.
HIGH_TEMPERATURE_C = 80.0
LOW_TEMPERATURE_C = 20.0
PSI_PER_BAR = 14.5038
BAND_HIGH, BAND_LOW, BAND_NORMAL = "HIGH", "LOW", "NORMAL"
WINDOW_MINUTES = 15


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; text that is no timestamp becomes NULL instead of an error.

    A time without a date is no timestamp: Spark would put it on the day on which
    it happens to be read.
    """
    if fmt is None:
        return F.when(~text.rlike(r"^\s*T?\d{1,2}:"), F.try_to_timestamp(text))
    return F.try_to_timestamp(text, F.lit(fmt))


def instant(value: dt.datetime) -> Column:
    """A timestamp constant; without an offset of its own it is in session time.

    ``lit(datetime)`` would read it in the local time of the Python process.
    """
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def iso_text(moment: Column) -> Column:
    """ISO-8601 text; the fraction appears (six digits) only when there is one."""
    text = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.replace(text, F.lit(".000000"), F.lit(""))


def to_fahrenheit(celsius: Column) -> Column:
    return celsius * F.lit(9) / F.lit(5) + F.lit(32)


def to_psi(bar: Column) -> Column:
    return bar * F.lit(PSI_PER_BAR)


def temperature_band(celsius: Column) -> Column:
    """HIGH / LOW / NORMAL. Unknown is NORMAL, and NaN sorts above every number: HIGH."""
    return (
        F.when(celsius > F.lit(HIGH_TEMPERATURE_C), BAND_HIGH)
        .when(celsius < F.lit(LOW_TEMPERATURE_C), BAND_LOW)
        .otherwise(BAND_NORMAL)
    )


def is_fault(label: Column) -> Column:
    return label > F.lit(0)


def fault_display(flag: Column) -> Column:
    return F.when(flag, "FAULT").otherwise("OK")


def bucket_start(moment: Column, minutes: int = WINDOW_MINUTES) -> Column:
    """Start of the tumbling bucket that holds ``moment``.

    Integer arithmetic on the epoch, so neither a daylight-saving overlap nor a
    time before 1970 moves a row to another bucket.
    """
    width = minutes * 60 * 1_000_000
    micros = F.unix_micros(moment)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))


def epoch_to_timestamp(epoch: Column, unit: str) -> Column:
    """Epoch number in ``s``, ``ms``, ``us`` or ``ns`` to a timestamp.

    Nanoseconds are floored to the microsecond with integer arithmetic: a
    double cannot hold a nanosecond epoch exactly.
    """
    epoch = epoch.cast("bigint")
    if unit == "s":
        return F.timestamp_seconds(epoch)
    if unit == "ms":
        return F.timestamp_millis(epoch)
    if unit == "us":
        return F.timestamp_micros(epoch)
    if unit == "ns":
        thousand = F.lit(1000).cast("bigint")
        # ``div`` truncates toward zero; taking the remainder off first makes it a floor.
        return F.timestamp_micros(F.call_function("div", epoch - F.pmod(epoch, thousand), thousand))
    raise ValueError(f"unknown epoch unit: {unit!r}")


def percentage(part: Column, whole: Column) -> Column:
    return part * F.lit(100.0) / whole


def mean_of(total: Column, count: Column) -> Column:
    """Average from its two parts; NULL when nothing was counted."""
    return F.when(count > 0, total / count)
