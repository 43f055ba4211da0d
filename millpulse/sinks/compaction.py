"""Turning many small per-batch partitions into a few well-sized files.

Closed days are rewritten into generations: folders of a second table, by day and
generation. A list beside it names, for every day and generation, the batches
that went in; it is written last, and a generation without it does not exist for
readers. A reader takes the newest generation of each day and, from the live
table, the batches that are not in it: late rows count as soon as they are stored,
and none counts twice. Compacting a day again merges its newest generation with
the live batches it lacks, so batches that are in may be retired.

Retiring has two steps. A batch is first listed, with the time; it is deleted by a
later call, once it has been listed for the grace period. A reader that planned its
files before the compaction was visible therefore has that long to end.
"""

from __future__ import annotations

import datetime as dt
import itertools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.operators.metrics import finish, merge_partials, newest_states
from millpulse.schemas import BATCH_KEY, with_batch_key
from millpulse.sinks.batch_tables import PARTIALS, BatchTable, TableLayout

_GENERATION = T.StructField("generation", T.LongType())


def _read(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The stored rows; none before the first compaction."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _contents(spark: SparkSession, layout: TableLayout, root: str) -> DataFrame:
    """(day, stream_id, batch_id, generation) of the newest generation of each day."""
    kind = layout.schema[layout.day]
    schema = T.StructType(
        [kind, T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType()), _GENERATION]
    )
    listed = _read(spark, schema, f"{root}/contents")
    newest = listed.groupBy(layout.day).agg(F.max("generation").alias("generation"))
    return listed.join(newest, [layout.day, "generation"], "left_semi")


def _compacted(spark: SparkSession, layout: TableLayout, root: str) -> DataFrame:
    stored = with_batch_key(layout.schema)
    schema = T.StructType([*(stored[name] for name in layout.kept), _GENERATION])
    newest = _contents(spark, layout, root).select(layout.day, "generation").distinct()
    rows = _read(spark, schema, f"{root}/days")
    return rows.join(newest, [layout.day, "generation"], "left_semi").select(*layout.kept)


def _missing(live: DataFrame, layout: TableLayout, root: str) -> DataFrame:
    """Live rows that no newest generation holds; rows without a day among them."""
    included = _contents(live.sparkSession, layout, root).select(layout.day, *BATCH_KEY)
    return live.join(included, [layout.day, *BATCH_KEY], "left_anti")


def compact(
    live: DataFrame, layout: TableLayout, root: str, cutoff: dt.date, since: dt.date | None = None
) -> None:
    """Bring the days in [since, cutoff) that have new batches into a new generation.

    One compaction of a table runs at a time. On the way metric parts are merged to
    one row per window and machine, window states to the newest of each stream.
    """
    spark, day = live.sparkSession, F.col(layout.day)
    closed = day < F.lit(cutoff)
    if since is not None:
        closed = closed & (day >= F.lit(since))
    new = _missing(live.filter(closed), layout, root)
    batches = new.select(layout.day, *BATCH_KEY).distinct()
    touched = batches.select(layout.day).distinct()
    before = _contents(spark, layout, root)
    number = (before.agg(F.max("generation")).first()[0] or 0) + 1
    # The batches of a generation are fixed before its rows are read: a batch
    # stored meanwhile stays live.
    listed = before.drop("generation").join(touched, layout.day, "left_semi").unionByName(batches)
    listed = listed.collect()  # a row per batch and day of the days that change
    if not listed:
        return
    contents = spark.createDataFrame(listed, T.StructType(before.drop("generation").schema.fields))
    days = contents.select(layout.day).distinct()
    added = live.join(contents, [layout.day, *BATCH_KEY], "left_semi")
    added = _missing(added, layout, root).select(*layout.kept)
    rows = _compacted(spark, layout, root).join(days, layout.day, "left_semi").unionByName(added)
    if layout.merge == "parts":
        rows = merge_partials(rows).withColumn(layout.day, F.to_date("window_start"))
    elif layout.merge == "newest":
        rows = newest_states(rows)
    rows = rows.select(*layout.kept)
    # The rebalance hint shuffles by day and lets adaptive execution split a
    # large day over several tasks and put small days together.
    (
        rows.hint("rebalance", day)
        .withColumn("generation", F.lit(number).cast("bigint"))
        .sortWithinPartitions(layout.day, *layout.cluster)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(layout.day, "generation")
        .parquet(f"{root}/days")
    )
    contents.withColumn("generation", F.lit(number).cast("bigint")).coalesce(1).write.mode("append").parquet(
        f"{root}/contents"
    )


def read_rows(live: DataFrame, layout: TableLayout, root: str | None) -> DataFrame:
    """All rows, compacted and live; metric parts still to be merged, and states
    (with their batch) still to replace each other."""
    if root is None:
        return live.select(*layout.kept)
    rows = _missing(live, layout, root).select(*layout.kept)
    return _compacted(live.sparkSession, layout, root).unionByName(rows)


def days(spark: SparkSession, layout: TableLayout, root: str | None) -> list[dt.date]:
    """Days that have a generation."""
    if root is None:
        return []
    listed = _contents(spark, layout, root).select(layout.day).distinct().collect()
    return sorted(r[0] for r in listed if r[0] is not None)


def read_days(
    spark: SparkSession, table: BatchTable, root: str | None, since: dt.date, until: dt.date
) -> DataFrame:
    """``read_rows`` of the days in [since, until) and of rows without a day."""
    day = F.col(table.layout.day)
    rows = read_rows(table.read_days(spark, since, until), table.layout, root)
    return rows if root is None else rows.filter(((day >= F.lit(since)) & (day < F.lit(until))) | day.isNull())


def read_metrics(live: DataFrame, root: str | None) -> DataFrame:
    """Final metrics of all days, one row per window and machine."""
    return finish(merge_partials(read_rows(live, PARTIALS, root)))


#: Batches deleted from one list on the driver.
RETIRED_AT_ONCE = 10_000


def retire(
    spark: SparkSession, table: BatchTable, root: str, grace: dt.timedelta = dt.timedelta(0),
    now: dt.datetime | None = None,
) -> int:
    """List the live batches that are in the newest generation of their day, and
    delete those that have been listed for the ``grace`` period. Returns how many
    were deleted. Without grace both happen at once, which a running reader of live
    rows does not survive. A call that fails half way is made good by the next."""
    layout, now = table.layout, now or dt.datetime.now(dt.timezone.utc)
    key = [layout.day, *BATCH_KEY]
    stored = table.read(spark).select(*key).distinct()
    included = _contents(spark, layout, root).select(*key)
    schema = T.StructType([*included.schema.fields, T.StructField("listed", T.TimestampType())])
    path = f"{root}/retiring"
    new = stored.join(included, key, "left_semi").join(_read(spark, schema, path), key, "left_anti")
    new.withColumn("listed", F.lit(now)).coalesce(1).write.mode("append").parquet(path)
    due = _read(spark, schema, path).filter(F.col("listed") <= F.lit(now - grace)).select(*key).distinct()
    rows, count = stored.join(due, key, "left_semi").toLocalIterator(), 0
    while some := [tuple(r) for r in itertools.islice(rows, RETIRED_AT_ONCE)]:
        table.drop_batches(spark, some)
        count += len(some)
    return count
