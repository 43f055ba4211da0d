"""Reading catalog tables, optionally at a named branch or version."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.functions import scalar as S


def branch_query(name: str, branch: str) -> str:
    quoted = branch.replace("'", "''")
    return f"SELECT * FROM {name} VERSION AS OF '{quoted}'"


def read_table(spark: SparkSession, name: str, branch: str | None = None) -> DataFrame:
    """A table by its one- to three-part name.

    ``branch`` is handed to the catalog as ``VERSION AS OF``; only versioned
    catalogs accept it. A catalog that is mounted at a reference (see
    ``session.versioned_catalog_conf``) needs no branch here.
    """
    if branch is None:
        return spark.table(name)
    return spark.sql(branch_query(name, branch))


def in_time_range(
    rows: DataFrame,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    time: str = "event_time",
    day: str = "date",
) -> DataFrame:
    """Rows with ``start <= time < end``.

    Spark does not derive a condition on the partition column ``day`` from one
    on ``time``, so both are bounded: whole days are pruned before any file is
    opened.
    """
    if start is not None:
        since = S.instant(start)
        rows = rows.filter((F.col(time) >= since) & (F.col(day) >= F.to_date(since)))
    if end is not None:
        until = S.instant(end)
        rows = rows.filter((F.col(time) < until) & (F.col(day) <= F.to_date(until)))
    return rows
