import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.operators.history import metrics_from_aggregates
from millpulse.operators.metrics import (
    merged_window_metrics,
    metric_partials,
    struct_window_aggregates,
    window_metrics,
)
from millpulse.schemas import AGGREGATE_V1, METRIC

SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("temperature_c", T.DoubleType()),
        T.StructField("vibration_mms", T.DoubleType()),
        T.StructField("pressure_bar", T.DoubleType()),
        T.StructField("is_fault", T.BooleanType()),
        T.StructField("processing_time", T.TimestampType()),
    ]
)
T0 = dt.datetime(2024, 1, 1)


def readings(spark, rows):
    return spark.createDataFrame([(*r, T0) for r in rows], SCHEMA)


def random_rows(n, seed=1):
    """A third of the rows belongs to one machine and window."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        hot = rng.random() < 1 / 3
        minute = 0 if hot else rng.randrange(600)
        machine = "hot" if hot else f"m{rng.randrange(4)}"
        measure = lambda: rng.choice([None, round(rng.uniform(0, 100), 2)])
        rows.append((T0 + dt.timedelta(minutes=minute), machine, measure(), measure(), measure(),
                     rng.choice([True, False, None])))
    return rows


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            start = row[0] - dt.timedelta(minutes=row[0].minute % 15, seconds=row[0].second)
            groups[start, row[1]].append(row)
    out = {}
    for key, members in groups.items():
        def known(i):
            return [m[i] for m in members if m[i] is not None]

        def mean(i):
            return math.fsum(known(i)) / len(known(i)) if known(i) else None

        faults = sum(m[5] is True for m in members)
        out[key] = (mean(2), max(known(2), default=None), min(known(2), default=None), mean(3),
                    max(known(3), default=None), mean(4), faults, len(members),
                    faults * 100.0 / len(members))
    return out


def by_key(frame):
    names = METRIC.names[3:12]
    return {(r["window_start"], r["machine_id"]): tuple(r[n] for n in names) for r in frame.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


def test_metrics_equal_brute_force(spark):
    rows = [*random_rows(2000), (None, "m1", 1.0, 1.0, 1.0, True)]
    result = window_metrics(readings(spark, rows))
    assert result.schema.names == METRIC.names
    assert_same(by_key(result), brute_force(rows))


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_parts_merge_to_the_direct_result(spark, parts):
    rows = random_rows(1500, seed=parts)
    batch = F.pmod(F.hash("temperature_c", "event_time"), F.lit(parts))
    frame = readings(spark, rows).withColumn("batch", batch)
    partials = metric_partials(frame, "15 minutes", "batch")
    assert_same(by_key(merged_window_metrics(partials)), brute_force(rows))


def test_unknown_faults_count_as_zero(spark):
    rows = [(T0, "m", 1.0, 1.0, 1.0, None)] * 2
    row = window_metrics(readings(spark, rows)).first()
    assert (row["fault_count"], row["fault_percentage"]) == (0, 0.0)


def test_nan_and_null_measures(spark):
    rows = [(T0, "m", float("nan"), None, 2.0, True), (T0, "m", 5.0, None, None, False)]
    row = window_metrics(readings(spark, rows)).first()
    assert math.isnan(row["avg_temperature"]) and math.isnan(row["max_temperature"])
    assert row["min_temperature"] == 5.0
    assert row["avg_vibration"] is None and row["max_vibration"] is None
    assert row["avg_pressure"] == 2.0


def test_machine_may_be_unknown(spark):
    row = window_metrics(readings(spark, [(T0, None, 1.0, 1.0, 1.0, True)])).first()
    assert row["machine_id"] is None and row["total_readings"] == 1


def test_older_struct_form_and_back(spark):
    frame = readings(spark, random_rows(300))
    older = struct_window_aggregates(frame)
    assert [(f.name, f.dataType) for f in older.schema["window"].dataType] == [
        ("start", T.TimestampType()), ("end", T.TimestampType())]
    assert older.schema.names == AGGREGATE_V1.names
    assert_same(by_key(metrics_from_aggregates(older)), by_key(window_metrics(frame)))


def test_one_shuffle_and_partial_aggregation(spark):
    plan = window_metrics(readings(spark, random_rows(10)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
