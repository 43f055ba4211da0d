"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millpulse.workspace import scratch_path

#: Words end at these characters, and lines are stripped of them.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: the rows survive lost executors,
    are computed once, and what follows starts a new lineage."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of the frame."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
