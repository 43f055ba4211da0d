"""Databases, tables and views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millpulse.operators.metrics import finish, merge_partials, merge_sql, merged_window_metrics, newest_states, states_sql
from millpulse.schemas import (
    AGGREGATE_V1,
    AUDIT,
    BATCH_KEY,
    METRIC_PARTIAL,
    QUARANTINE,
    READING,
    READING_V1,
    with_batch_key,
)

READING_BATCHES = "sensor_reading_batches"
PARTIAL_BATCHES = "sensor_metric_batches"
QUARANTINE_BATCHES = "sensor_quarantine_batches"
WINDOW_STATES = "sensor_window_states"
AUDIT_BATCHES = "sensor_audit_batches"

# Names under which reports find readings and metrics.
READINGS_VIEW = "sensor_readings"
METRICS_VIEW = "sensor_metrics"
# Own name: metrics of the windows that a stream keeps as state.
WINDOWS_VIEW = "sensor_windows"
READINGS_V1 = "sensor_readings_v1"
AGGREGATES_V1 = "sensor_aggregates"

# Stream and batch come first: an insert names both and lists no other partition.
_STORED = {
    READING_BATCHES: (with_batch_key(READING), (*BATCH_KEY, "date")),
    PARTIAL_BATCHES: (with_batch_key(METRIC_PARTIAL), (*BATCH_KEY, "window_date")),
    QUARANTINE_BATCHES: (with_batch_key(QUARANTINE), (*BATCH_KEY, "quarantine_date")),
    AUDIT_BATCHES: (with_batch_key(AUDIT), (*BATCH_KEY, "audit_date")),
    # States of one window replace each other; merged like parts they would add up.
    WINDOW_STATES: (with_batch_key(METRIC_PARTIAL), (*BATCH_KEY, "window_date")),
}
_OLDER = {
    READINGS_V1: (READING_V1, ("date",)),
    AGGREGATES_V1: (AGGREGATE_V1, ("machine_id",)),
}


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def table_properties(provider: str) -> dict[str, str]:
    """Parquet files with snappy compression, in the words of the table format."""
    if provider == "iceberg":
        return {"write.format.default": "parquet", "write.parquet.compression-codec": "snappy"}
    return {}


def create_table_sql(
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    provider: str = "parquet",
    location: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> str:
    columns = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n) USING {provider}"]
    if provider == "parquet":
        parts.append("OPTIONS ('compression' = 'snappy')")
    if partition_by:
        parts.append(f"PARTITIONED BY ({', '.join(partition_by)})")
    if location:
        parts.append(f"LOCATION '{location}'")
    merged = {**table_properties(provider), **(properties or {})}
    if merged:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in merged.items())
        parts.append(f"TBLPROPERTIES ({pairs})")
    return "\n".join(parts)


def create_tables(
    spark: SparkSession,
    database: str,
    provider: str = "parquet",
    location: str | None = None,
    older: bool = False,
) -> list[str]:
    """Create the database and its stored tables where they are absent.

    ``older`` adds the tables of the previous layout, as input for upgrades.
    """
    create_database(spark, database)
    names = []
    for table, (schema, partition_by) in {**_STORED, **(_OLDER if older else {})}.items():
        name = f"{database}.{table}"
        where = f"{location.rstrip('/')}/{table}" if location else None
        spark.sql(create_table_sql(name, schema, partition_by, provider, where))
        names.append(name)
    return names


def create_views(spark: SparkSession, database: str) -> None:
    """Lasting views with the exact reading and metric columns, for SQL users.

    The metric view merges the parts of all micro-batches, so a window has one
    row however often its machine reported.
    """
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{READINGS_VIEW} AS "
        f"SELECT {', '.join(f'`{c}`' for c in READING.names)} FROM {database}.{READING_BATCHES}"
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{METRICS_VIEW} AS {merge_sql(f'{database}.{PARTIAL_BATCHES}')}"
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{WINDOWS_VIEW} AS {states_sql(f'{database}.{WINDOW_STATES}')}"
    )


def register_views(readings: DataFrame, partials: DataFrame, states: DataFrame | None = None) -> None:
    """The same views for the session of these rows only, over any stored tables."""
    readings.select(*READING.names).createOrReplaceTempView(READINGS_VIEW)
    merged_window_metrics(partials).createOrReplaceTempView(METRICS_VIEW)
    if states is not None:
        finish(merge_partials(newest_states(states))).createOrReplaceTempView(WINDOWS_VIEW)
