"""Comparing two states of a table, and reading older table versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpulse.operators.enrich import derived_columns
from millpulse.schemas import READING


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str]
) -> DataFrame:
    """What was added, removed or changed between two states of a table.

    Result: ``keys``, ``change_type``, ``old_<c>`` and ``new_<c>`` for every
    compared column, and ``copies``.

    Rows are compared as multisets. Equal rows of both sides cancel out in one
    aggregation whose map side already collapses copies; only the differences
    go on. A key that lost exactly one row and gained exactly one is
    ``changed``. Where a key is not unique and more than that happened, each
    row is reported as ``removed`` or ``added`` with its number of copies, so
    nothing is paired at random or multiplied by a join.
    """
    keys, compare = list(keys), list(compare)

    def side(rows: DataFrame, weight: int) -> DataFrame:
        return rows.select(*keys, *compare, F.lit(weight).cast("bigint").alias("_weight"))

    surplus = (
        side(old, -1)
        .unionByName(side(new, 1))
        .groupBy(*keys, *compare)
        .agg(F.sum("_weight").alias("_surplus"))
        .filter(F.col("_surplus") != 0)
    )
    gone, came = F.col("_surplus") < 0, F.col("_surplus") > 0
    # One row left and one came, so the maximum over the lost rows is that row's value.
    replaced = (
        surplus.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys])
        .agg(
            F.sum(F.when(gone, -F.col("_surplus"))).alias("_gone"),
            F.sum(F.when(came, F.col("_surplus"))).alias("_came"),
            *[F.max(F.when(gone, F.col(c))).alias(f"_old_{c}") for c in compare],
        )
        .filter((F.col("_gone") == 1) & (F.col("_came") == 1))
    )
    # A key may be NULL, hence the null-safe match.
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    matched = F.col("_gone").isNotNull()
    return (
        surplus.join(replaced, same_key, "left")
        .filter(came | ~matched)
        .select(
            *keys,
            F.when(matched, "changed").when(came, "added").otherwise("removed").alias("change_type"),
            *[
                F.when(matched, F.col(f"_old_{c}")).when(gone, F.col(c)).alias(f"old_{c}")
                for c in compare
            ],
            *[F.when(came, F.col(c)).alias(f"new_{c}") for c in compare],
            F.abs("_surplus").alias("copies"),
        )
    )


def upgrade_readings(readings: DataFrame, *keep: str) -> DataFrame:
    """Older or mixed readings in the current column set.

    A derived column that is absent, or NULL in rows from before it existed, is
    computed again. ``processing_time`` cannot be, and stays NULL.
    """
    derived = derived_columns()
    fields = {f.name: f for f in READING.fields}
    columns = []
    for name, field in fields.items():
        present = name in readings.columns
        if name in derived and present:
            columns.append(F.coalesce(F.col(name), derived[name]).alias(name))
        elif name in derived:
            columns.append(derived[name].alias(name))
        elif present:
            columns.append(F.col(name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(name))
    return readings.select(*keep, *columns)


def unify_readings(v1: DataFrame, v2: DataFrame, *keep: str) -> DataFrame:
    """Both versions of the readings table as one."""
    return upgrade_readings(v1, *keep).unionByName(v2.select(*keep, *READING.names))


def metrics_from_aggregates(aggregates: DataFrame) -> DataFrame:
    """The older aggregate table (struct window) in the form of the metrics table."""
    faults, total = F.col("fault_count").cast("bigint"), F.col("reading_count").cast("bigint")
    return aggregates.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "machine_id",
        "avg_temperature",
        "max_temperature",
        "min_temperature",
        "avg_vibration",
        "max_vibration",
        "avg_pressure",
        faults.alias("fault_count"),
        total.alias("total_readings"),
        F.when(total > 0, faults * F.lit(100.0) / total).alias("fault_percentage"),
        F.lit(None).cast("timestamp").alias("processing_time"),
    )
