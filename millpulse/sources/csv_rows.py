"""Sensor rows in CSV files with a header line."""

from __future__ import annotations

import functools
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.schemas import CSV_COLUMNS, CSV_ROWS

_OPTIONS = {"header": True, "encoding": "UTF-8"}


def _files_by_first_line(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """Files with equal first lines together, found in one job. The first line of a
    file is the first that is not blank in the piece at its start: rows of a piece
    are read in order by one task."""
    lines = spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("row"),
    )
    first = (
        lines.filter((F.col("at") == 0) & (F.trim("value") != "")).groupBy("file")
        .agg(F.min_by("value", "row").alias("line"))
    )
    grouped = first.groupBy("line").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return [[unquote(file) for file in row["files"]] for row in grouped.orderBy("files").collect()]


def read_csv_rows(spark: SparkSession, path: str | list[str], one_header: bool = False) -> DataFrame:
    """All cells as text under the file's own header names (UTF-8).

    Columns are found by name, so files may have them in another order, and others
    beside them. One job finds the first line of every file, and one more for each
    different line reads the names in it; with ``one_header`` the header of the
    first file counts for all and the first job is saved. Files of one header are
    read together, each file once. Typing happens in ``operators.encode``.
    """
    if one_header:
        groups = [sorted(map(unquote, spark.read.text(path).inputFiles()))]
    else:
        groups = _files_by_first_line(spark, path)
    parts = []
    for group in groups:
        header = tuple(spark.read.options(**_OPTIONS).csv(group[0]).columns) if group else ()
        # An empty file, of a task without rows, has no header and no rows.
        if not header:
            continue
        missing = [name for name in CSV_COLUMNS if name not in header]
        if missing:
            raise ValueError(f"no column {', '.join(map(repr, missing))} in {group[0]}")
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
        rows = spark.read.schema(schema).options(**_OPTIONS, enforceSchema=False).csv(group)
        parts.append(rows.select(*(f"`{name}`" for name in CSV_COLUMNS)))
    if not parts:
        return spark.createDataFrame([], CSV_ROWS)
    return functools.reduce(DataFrame.unionByName, parts)
