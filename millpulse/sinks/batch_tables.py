"""Tables written one micro-batch at a time, safe to replay.

Every row carries the id of its stream and of its micro-batch in partition
columns. A batch that is run again after a failure has the same rows, hence the
same partitions, and replaces what its first attempt left behind. Batches of
other streams, and of the same stream under a new checkpoint, have another
stream id and are never touched.
"""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.schemas import AUDIT, BATCH_KEY, METRIC_PARTIAL, QUARANTINE, READING, with_batch_key
from millpulse.session import setting
from millpulse.sources.tables import read_table

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class TableLayout:
    """Columns of a table, its day partition, the order of rows in a file, and what
    compaction does with rows of one window: ``none``, ``parts`` that add up, or
    states of which only the ``newest`` of each stream counts."""

    schema: T.StructType
    day: str
    cluster: tuple[str, ...]
    merge: str = "none"

    @property
    def kept(self) -> list[str]:
        """Columns of compacted rows. States keep their batch: a newer one may come."""
        return [*self.schema.names, *(BATCH_KEY if self.merge == "newest" else ())]


READINGS = TableLayout(READING, "date", ("machine_id", "event_time"))
PARTIALS = TableLayout(METRIC_PARTIAL, "window_date", ("machine_id", "window_start"), "parts")
STATES = TableLayout(METRIC_PARTIAL, "window_date", ("machine_id", "window_start"), "newest")
AUDITED = TableLayout(AUDIT, "audit_date", ())
QUARANTINED = TableLayout(QUARANTINE, "quarantine_date", ("reason",))


@dataclass(frozen=True)
class BatchId:
    """A micro-batch: the durable id of its stream, and its number there."""

    stream: str
    number: int


def _stored(rows: DataFrame, layout: TableLayout, batch: BatchId, rebalance: bool) -> DataFrame:
    """Rows in table column order, sorted the way the partitioned writer needs.

    The sort stays inside each task. Sorting by machine within the day gives
    tight column statistics, so a filter on a machine skips row groups.

    Without ``rebalance`` there is no shuffle and each task writes one file per
    day it holds: right for a live stream, whose batch covers a day or two.
    With it, rows are first brought together by day, large days split over
    several tasks and small ones joined by adaptive execution: right for small
    aggregates, and for a backfill that mixes many days in every task.
    """
    if rebalance:
        rows = rows.hint("rebalance", F.col(layout.day))
    return rows.select(
        *layout.schema.names,
        F.lit(batch.stream).alias("stream_id"),
        F.lit(batch.number).cast("bigint").alias("batch_id"),
    ).sortWithinPartitions(layout.day, *layout.cluster)


@dataclass(frozen=True)
class PathTable:
    """Partitioned parquet files under one root folder: by day, stream and batch."""

    root: str
    layout: TableLayout
    compression: str = "snappy"

    #: Longest range of days whose folders are named one by one.
    LISTED_DAYS = 100

    def replace_batch(self, rows: DataFrame, batch: BatchId, rebalance: bool = False) -> None:
        (
            _stored(rows, self.layout, batch, rebalance)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", self.compression)
            .partitionBy(self.layout.day, *BATCH_KEY)
            .parquet(self.root)
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; none if nothing is stored yet."""
        return self._read(spark, self.root)

    def _read(self, spark: SparkSession, folders: str) -> DataFrame:
        schema = with_batch_key(self.layout.schema)
        try:
            return spark.read.schema(schema).option("basePath", self.root).parquet(folders)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            folders_last = (self.layout.day, *BATCH_KEY)
            names = [c for c in schema.names if c not in folders_last]
            return spark.createDataFrame([], schema).select(*names, *folders_last)

    def days(self, spark: SparkSession) -> list[dt.date]:
        """Days that have a folder: one listing, no file is opened."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(_days_in(name.removeprefix(f"{self.layout.day}=") for name in names))

    def read_days(self, spark: SparkSession, since: dt.date, until: dt.date) -> DataFrame:
        """Rows of the days in [since, until), and those without a day; none if
        nothing is stored there.

        Only the folders of these days are listed. A table that is written every
        few seconds has thousands of folders a day, and listing all of them to
        read a few takes longer than reading. Of a long range the whole table is
        listed, and days outside of it are pruned.
        """
        if (until - since).days > self.LISTED_DAYS:
            return _within(self.read(spark), self.layout.day, since, until)
        days = [str(since + dt.timedelta(days=i)) for i in range((until - since).days)]
        return self._read(spark, f"{self.root}/{self.layout.day}={{{','.join([*days, _NO_DAY])}}}")

    def drop_batches(self, spark: SparkSession, batches: list[tuple[dt.date, str, int]]) -> None:
        """Delete the folders of the given (day, stream, batch), many at a time."""
        name = _folder_names(spark)
        delete_folders(
            spark,
            [
                f"{self.root}/{self.layout.day}={day}/stream_id={name(stream)}/batch_id={number}"
                for day, stream, number in batches
            ],
        )


#: Folders deleted at a time. A store answers each call slowly, but many at once.
DELETERS = 32
#: Partitions named in one statement.
NAMED_PARTITIONS = 500


def _folder_names(spark: SparkSession):
    """How a partition value is spelled in a folder name."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def delete(folder: str) -> None:
        path = path_of(folder)
        path.getFileSystem(conf).delete(path, True)

    with ThreadPoolExecutor(DELETERS) as pool:
        for _ in pool.map(delete, folders):
            pass


def _days_in(names: Iterable[str]) -> set[dt.date]:
    found = set()
    for name in names:
        try:
            found.add(dt.date.fromisoformat(name))
        except ValueError:  # the folder of rows without a day, or a file beside the folders
            continue
    return found


def batch_ranges(batches: Iterable[tuple[dt.date, str, int]]) -> Iterator[tuple[str, dt.date, int, int]]:
    """(stream, day, first, last) of consecutive batch numbers."""
    by = sorted((stream, day, number) for day, stream, number in batches)
    for (stream, day, _), run in itertools.groupby(
        enumerate(by), lambda item: (item[1][0], item[1][1], item[1][2] - item[0])
    ):
        numbers = [number for _, (_, _, number) in run]
        yield stream, day, numbers[0], numbers[-1]


def _within(rows: DataFrame, day_column: str, since: dt.date, until: dt.date) -> DataFrame:
    day = F.col(day_column)
    return rows.filter(((day >= F.lit(since)) & (day < F.lit(until))) | day.isNull())


@dataclass(frozen=True)
class CatalogTable:
    """A catalog table made by ``ddl.create_tables``.

    ``versioned`` tables (a catalog with snapshots) replace their partitions in
    one atomic commit, and can be read at a ``branch``.
    """

    name: str
    layout: TableLayout
    versioned: bool = False
    branch: str | None = None

    def replace_batch(self, rows: DataFrame, batch: BatchId, rebalance: bool = False) -> None:
        stored = _stored(rows, self.layout, batch, rebalance)
        if self.versioned:
            stored.writeTo(self.name).overwritePartitions()
            return
        # Stream and batch are named in the statement: the catalog lists the
        # partitions of this batch only, however many the table has.
        columns = [c for c in self.layout.schema.names if c != self.layout.day]
        target = f"stream_id = '{batch.stream}', batch_id = {batch.number}, {self.layout.day}"
        # The overwrite mode is a matter of the session: in the default (static)
        # mode the days of the batch would be emptied before they are written.
        spark = rows.sparkSession
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            spark.sql(
                f"INSERT OVERWRITE TABLE {self.name} PARTITION ({target}) "
                f"SELECT {', '.join(f'`{c}`' for c in [*columns, self.layout.day])} FROM {{rows}}",
                rows=stored,
            )

    def read(self, spark: SparkSession) -> DataFrame:
        columns = with_batch_key(self.layout.schema).names
        return read_table(spark, self.name, self.branch).select(*columns)

    def read_days(self, spark: SparkSession, since: dt.date, until: dt.date) -> DataFrame:
        """Rows of the days in [since, until), and those without a day; pruned by the catalog."""
        return _within(self.read(spark), self.layout.day, since, until)

    def days(self, spark: SparkSession) -> list[dt.date]:
        """Days of the table's partitions."""
        if self.versioned:
            rows = spark.table(self.name).select(F.col(self.layout.day).cast("string"))
        else:
            listed = F.regexp_extract("partition", f"(?:^|/){self.layout.day}=([^/]+)", 1)
            rows = spark.sql(f"SHOW PARTITIONS {self.name}").select(listed)
        return sorted(_days_in(r[0] for r in rows.distinct().collect() if r[0]))

    def drop_batches(self, spark: SparkSession, batches: list[tuple[dt.date, str, int]]) -> None:
        """Delete the given (day, stream, batch), many in one statement."""
        day_column = self.layout.day
        if self.versioned:
            ranges = [
                f"(stream_id = '{stream}' AND {day_column} = DATE '{day}' AND batch_id BETWEEN {first} AND {last})"
                for stream, day, first, last in batch_ranges(batches)
            ]
            for k in range(0, len(ranges), NAMED_PARTITIONS):
                where = " OR ".join(ranges[k : k + NAMED_PARTITIONS])
                spark.sql(f"DELETE FROM {self.name} WHERE {where}")
            return
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        location = described.filter("col_name = 'Location'").first()["data_type"]
        for k in range(0, len(batches), NAMED_PARTITIONS):
            named = ", ".join(
                f"PARTITION (stream_id = '{stream}', batch_id = {number}, {day_column} = DATE '{day}')"
                for day, stream, number in batches[k : k + NAMED_PARTITIONS]
            )
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {named}")
        # Dropping a partition of an external table leaves its files.
        name = _folder_names(spark)
        delete_folders(
            spark,
            [
                f"{location}/stream_id={name(stream)}/batch_id={number}/{day_column}={day}"
                for day, stream, number in batches
            ],
        )


BatchTable = PathTable | CatalogTable


def append_table(rows: DataFrame, name: str) -> None:
    """Plain append to an existing table, columns matched by name. Not safe to replay."""
    # insertInto matches by position.
    rows.select(*rows.sparkSession.table(name).columns).write.insertInto(name)
