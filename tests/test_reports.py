import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from millpulse.operators import reports
from millpulse.operators.enrich import enrich
from millpulse.operators.metrics import window_metrics
from millpulse.schemas import EVENT, READING
from millpulse.sources.tables import in_time_range


def events(spark, rows):
    """rows of (timestamp, machine, vibration, temperature, pressure, fault)"""
    full = [(t, m, v, c, p, None, None, f) for t, m, v, c, p, f in rows]
    return enrich(spark.createDataFrame(full, EVENT))


@pytest.fixture(scope="module")
def readings(spark):
    return events(spark, [
        ("2024-01-01T00:00:00", "m1", 1.0, 90.0, 1.0, 0),
        ("2024-01-01T01:00:00", "m1", None, 30.0, 2.6, 1),
        ("2024-01-09T01:00:00", "m2", 8.1, None, None, None),
        ("2024-01-09T02:00:00", "m2", 8.0, 80.0, 2.5, 1),
        ("garbage", "m3", 9.0, 10.0, 1.0, 0),
    ]).cache()


def test_trend_needs_time_and_temperature(readings):
    rows = reports.temperature_trend(readings).collect()
    assert [r["temperature_c"] for r in rows] == [90.0, 30.0, 80.0]
    assert rows[0].asDict().keys() == {"machine_id", "event_time", "temperature_c"}


def test_trend_spreads_copies_of_one_reading(spark):
    copies = spark.range(0, 40_000, 1, 8).select(
        F.lit("m1").alias("machine_id"),
        F.lit("2024-01-01").cast("timestamp").alias("event_time"),
        F.lit(20.0).alias("temperature_c"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [
            r["count"]
            for r in reports.temperature_trend(copies).groupBy(F.spark_partition_id()).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 40_000 and max(sizes) < 20_000


def test_faults_per_machine(readings):
    rows = [tuple(r) for r in reports.fault_by_machine(readings).collect()]
    assert rows == [("m1", 2, 1, 50.0), ("m2", 2, 1, 50.0), ("m3", 1, 0, 0.0)]


def test_percentage_rounds_half_up(spark):
    rows = [("2024-01-01T00:00:00", "m", 1.0, 1.0, 1.0, int(i == 0)) for i in range(800)]
    assert reports.fault_by_machine(events(spark, rows)).first()["fault_percentage"] == 0.13


def test_hours(readings):
    rows = {r["hour"]: r for r in reports.hourly_patterns(readings).collect()}
    assert rows[1]["reading_count"] == 2 and rows[1]["fault_count"] == 1
    assert rows[1]["avg_temperature"] == 30.0 and rows[1]["avg_vibration"] == 8.1
    assert None in rows


def test_risk_is_any_of_three_even_with_unknown_measures(readings):
    rows = reports.recent_high_risk(readings).collect()
    assert [r["temperature_c"] for r in rows] == [None, 30.0, 90.0, 10.0]
    assert reports.recent_high_risk(readings, limit=2).count() == 2


def test_risk_or_fault_adds_faults(readings):
    rows = reports.recent_risk_or_fault(readings).collect()
    assert [r["temperature_c"] for r in rows] == [80.0, None, 30.0, 90.0, 10.0]


def test_high_fault_windows(readings):
    rows = reports.high_fault_windows(window_metrics(readings)).collect()
    assert [(r["machine_id"], r["fault_percentage"]) for r in rows] == [("m2", 100.0), ("m1", 100.0)]
    assert reports.high_fault_windows(window_metrics(readings), 100).count() == 0


def test_daily_statistics_end_at_latest_or_stated_time(readings):
    rows = reports.daily_temperature_stats(readings).collect()
    assert [(str(r["date"]), r["machine_id"], r["reading_count"]) for r in rows] == [
        ("2024-01-09", "m2", 1)]
    earlier = reports.daily_temperature_stats(readings, as_of=dt.datetime(2024, 1, 8)).collect()
    assert [(str(r["date"]), r["max_temperature"]) for r in earlier] == [("2024-01-01", 90.0)]


def test_sample(readings):
    rows = reports.sample_readings(readings.filter("event_time is not null"), "event_time", n=2).collect()
    assert [r["hour"] for r in rows] == [0, 1]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, readings, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "readings")
    readings.write.partitionBy("date").parquet(path)
    return spark.read.schema(READING).parquet(path)


def test_top_k_is_fused_and_the_filter_reaches_the_scan(stored):
    text = plan(reports.recent_high_risk(stored))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "PushedFilters: [Or(Or(EqualTo(temp_status,HIGH),GreaterThan(vibration_mms,8.0))" in text
    assert "rms_vibration" not in text


def test_reports_read_only_their_columns(stored):
    text = plan(reports.fault_by_machine(stored))
    assert "ReadSchema: struct<machine_id:string,is_fault:boolean>" in text


def test_time_range_prunes_days(stored):
    found = in_time_range(stored, dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 9, 2))
    assert found.count() == 1
    text = plan(found)
    partition = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in partition and ">= 2024-01-09" in partition and "<= 2024-01-09" in partition


def test_trailing_days_prune_by_the_subquery(stored):
    found = reports.daily_temperature_stats(stored)
    found.collect()
    text = plan(found)
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ >= cast\([^\]]*ubquery", text)
    assert "LessThanOrEqual(event_time,ScalarSubquery" in text
    # The latest time is looked for in the latest day only, and this day among the
    # partitions' values, without reading a column.
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ = Subquery", text)
    assert "ReadSchema: struct<>" in text
