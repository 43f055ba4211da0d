"""Named queries over a folder of tables: ``name -> (spark, folder) -> DataFrame``.

Each query feeds the folder's ``events`` table through the operators and
shapes the result for comparison with plain SQL: timestamps without zone, and
averages rounded to six decimals (the order of a floating-point sum depends on
the partitioning).
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millpulse.functions import scalar as S
from millpulse.operators import encode, enrich, history, metrics, parse, profile, reports
from millpulse.schemas import EVENT, READING, READING_V1
from millpulse.sinks import batch_tables, compaction, ddl
from millpulse.sinks.messages import publish_files
from millpulse.sources import events as ev
from millpulse.sources.csv_rows import read_csv_rows
from millpulse.sources.messages import file_messages
from millpulse.sources.tables import in_time_range, read_table
from millpulse.streaming import windows
from millpulse.streaming.ingest import IngestTargets, start_ingest
from millpulse.workspace import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DECIMALS = 6
MEASURES = ("temperature_c", "vibration_mms", "pressure_bar")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _plain(result: DataFrame) -> DataFrame:
    """Timestamps without zone, under the same names."""
    zoned = {
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in result.schema.fields
        if isinstance(f.dataType, T.TimestampType)
    }
    return result.withColumns(zoned) if zoned else result


def _rounded(result: DataFrame, *names: str) -> DataFrame:
    """Doubles rounded: all of them, or ``names``."""
    doubles = [
        f.name
        for f in result.schema.fields
        if isinstance(f.dataType, T.DoubleType) and (not names or f.name in names)
    ]
    return _plain(result).withColumns({n: F.round(n, DECIMALS) for n in doubles})


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return ev.event_fields(ev.read_events(spark, folder))


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.derive(_events(spark, folder))


def _metric_columns(result: DataFrame) -> DataFrame:
    return _rounded(result.drop("processing_time"))


# --- messages -------------------------------------------------------------


def _message_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).withColumn("row_time", F.col("event_time"))


@query
def encode_messages(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode_messages(_message_rows(spark, folder), "event_id")


@query
def parse_messages(spark: SparkSession, folder: str) -> DataFrame:
    fields = F.struct(*EVENT.names)
    messages = _events(spark, folder).select(
        "event_id", F.to_json(fields).cast("binary").alias("value")
    )
    parsed = parse.parse_messages(messages, "event_id")
    return _plain(parsed.withColumn("event_time", S.parse_timestamp(F.col("timestamp"))))


@query
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    messages = ev.damaged_messages(ev.read_events(spark, folder))
    return parse.quarantine_counts(parse.classify_messages(messages))


@query
def quarantined_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = ev.damaged_messages(ev.read_events(spark, folder))
    classified = parse.classify_messages(messages, "event_id")
    return classified.filter(F.col("reason") != "valid").select("event_id", "reason")


def _csv_files(spark: SparkSession, folder: str) -> str:
    """Files of two column orders, one of them with a column more."""
    path = scratch_path(spark, "csv")
    cells = ev.csv_cells(ev.read_events(spark, folder), bad_every=97)
    names = [c for c in cells.columns if c != "event_id"]
    for part, order in enumerate((names, [*reversed(names), "event_id"])):
        rows = cells.filter(F.col("event_id") % 2 == part).select(*(f"`{c}`" for c in order))
        rows.write.mode("append").option("header", True).csv(path)
    return path


@query
def csv_readings(spark: SparkSession, folder: str) -> DataFrame:
    typed = encode.typed_rows(read_csv_rows(spark, _csv_files(spark, folder)))
    return _plain(encode.accepted_rows(typed))


@query
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    typed = encode.typed_rows(read_csv_rows(spark, _csv_files(spark, folder)))
    return (
        encode.rejected_rows(typed).groupBy("reject_reason").agg(F.count("*").alias("rejected"))
    )


@query
def csv_messages(spark: SparkSession, folder: str) -> DataFrame:
    """CSV cells to messages and back: what a consumer of the topic receives."""
    cells = ev.csv_cells(ev.read_events(spark, folder), bad_every=97)
    rows = encode.accepted_rows(encode.typed_rows(cells, "event_id"))
    machine = F.concat(F.lit("machine_"), (F.col("event_id") % 5 + 1).cast("string"))
    messages = encode.encode_messages(rows.withColumn("machine_id", machine), "event_id")
    return parse.parse_messages(messages, "event_id")


@query
def assign_machines(spark: SparkSession, folder: str) -> DataFrame:
    rows = encode.assign_machine(ev.read_events(spark, folder), 10, "event_id")
    return rows.select("event_id", "machine_id")


@query
def fault_flags(spark: SparkSession, folder: str) -> DataFrame:
    return encode.display_rows(_events(spark, folder)).select("event_id", "fault_flag")


@query
def epoch_precisions(spark: SparkSession, folder: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    epochs = ev.read_events(spark, folder).select(
        "event_id",
        F.call_function("div", micros, F.lit(1_000_000)).alias("s"),
        F.call_function("div", micros, F.lit(1_000)).alias("ms"),
        micros.alias("us"),
        (micros * 1_000 + 999).alias("ns"),
    )
    return _plain(
        epochs.select(
            "event_id",
            *[S.epoch_to_timestamp(F.col(u), u).alias(f"from_{u}") for u in ("s", "ms", "us", "ns")],
        )
    )


# --- readings and reports -------------------------------------------------


@query
def enrich_readings(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _events(spark, folder).select("event_id", *EVENT.names)
    return _plain(enrich.enrich(parsed, "event_id").drop("processing_time"))


@query
def temperature_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.temperature_trend(_readings(spark, folder))


@query
def fault_by_machine(spark: SparkSession, folder: str) -> DataFrame:
    return reports.fault_by_machine(_readings(spark, folder))


@query
def hourly_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.hourly_patterns(_readings(spark, folder)))


@query
def recent_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    return reports.recent_high_risk(_readings(spark, folder))


@query
def stored_recent_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a table by days, of which the newest are read first."""
    table = batch_tables.PathTable(f"{scratch_path(spark, 'recent')}/readings", batch_tables.READINGS)
    rows = enrich.enrich(_events(spark, folder).select(*EVENT.names))
    table.replace_batch(rows, batch_tables.BatchId("check", 0), rebalance=True)
    return _plain(
        reports.newest_first(
            table.days(spark), lambda since, until: table.read_days(spark, since, until),
            reports.recent_high_risk, reports.RECENT_LIMIT,
        )
    )


@query
def recent_risk_or_fault(spark: SparkSession, folder: str) -> DataFrame:
    return reports.recent_risk_or_fault(_readings(spark, folder))


@query
def daily_temperature_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.daily_temperature_stats(_readings(spark, folder)))


@query
def daily_temperature_stats_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing days that end at noon of the middle day of the events."""
    as_of = dt.datetime.combine(_middle(spark, folder), dt.time(12))
    return _rounded(reports.daily_temperature_stats(_readings(spark, folder), as_of=as_of))


@query
def sample_readings(spark: SparkSession, folder: str) -> DataFrame:
    ordered = _readings(spark, folder).select("event_id", "event_time", "machine_id", *MEASURES)
    return reports.sample_readings(ordered, "event_time", "event_id")


@query
def profile_readings(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.profile(_readings(spark, folder), MEASURES))


@query
def column_info(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_info(_events(spark, folder).select(*EVENT.names))


# --- window metrics -------------------------------------------------------


@query
def window_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _metric_columns(metrics.window_metrics(_readings(spark, folder)))


@query
def high_fault_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.high_fault_windows(metrics.window_metrics(_readings(spark, folder)))
    return _rounded(found)


@query
def merged_partials(spark: SparkSession, folder: str) -> DataFrame:
    """Parts per (window, machine, pretended batch), merged."""
    tagged = _readings(spark, folder).withColumn("batch", F.col("event_id") % 4)
    partials = metrics.metric_partials(tagged, metrics.WINDOW_LENGTH, "batch")
    return _metric_columns(metrics.merged_window_metrics(partials))


@query
def aggregates_v1_to_metrics(spark: SparkSession, folder: str) -> DataFrame:
    older = metrics.struct_window_aggregates(_readings(spark, folder))
    return _metric_columns(history.metrics_from_aggregates(older))


# --- streams and tables ---------------------------------------------------


#: A topic is published in files of so many messages, at least two for each step,
#: and read in steps of at most so many bytes, four of them at least.
FILE_MESSAGES = 200_000
STEPS = 4
STEP_BYTES = 1 << 30


def _days(spark: SparkSession, folder: str) -> tuple[dt.date, dt.date]:
    """First and last day of the events."""
    ends = ev.read_events(spark, folder).agg(F.min("ts"), F.max("ts")).first()
    return ends[0].date(), ends[1].date()


def _middle(spark: SparkSession, folder: str) -> dt.date:
    first, last = _days(spark, folder)
    return first + (last - first) // 2


def _targets(root: str, quarantine: bool = False) -> IngestTargets:
    return IngestTargets(
        batch_tables.PathTable(f"{root}/readings", batch_tables.READINGS),
        batch_tables.PathTable(f"{root}/partials", batch_tables.PARTIALS),
        batch_tables.PathTable(f"{root}/quarantine", batch_tables.QUARANTINED)
        if quarantine
        else None,
        batch_tables.PathTable(f"{root}/audit", batch_tables.AUDITED) if quarantine else None,
    )


def _files(messages: DataFrame, steps: int = STEPS) -> int:
    """Number of files of a topic, by the number of its messages."""
    return max(2 * steps, math.ceil(messages.count() / FILE_MESSAGES))


def _ingest(
    spark: SparkSession, topic: str, targets: IngestTargets, checkpoint: str, steps: int = STEPS
) -> None:
    """The topic in steps by bytes, each of several files; a step may hold many days."""
    size = spark.read.format("binaryFile").load(topic).select("length").agg(F.sum("length")).first()[0]
    start_ingest(
        file_messages(spark, topic, max_bytes_per_trigger=min(STEP_BYTES, math.ceil(size / steps) + 1)),
        targets,
        checkpoint,
        trigger={"availableNow": True},
        backfill=True,
    ).awaitTermination()


def _ingested(
    spark: SparkSession, folder: str, quarantine: bool = False, in_order: bool = True
) -> IngestTargets:
    """The events as a message stream in steps, ingested into tables.

    A topic holds its messages about in the order of time; unordered, every step
    has rows of every day and window.
    """
    root = scratch_path(spark, "ingest")
    if quarantine:
        events = ev.damaged_messages(ev.read_events(spark, folder))
        messages = events.select(
            "event_id", F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value")
        )
        publish_files(messages.repartitionByRange(_files(events), "event_id"), f"{root}/topic")
    else:
        rows = _message_rows(spark, folder)
        files = _files(rows)
        if in_order:
            rows = rows.repartitionByRange(files, "row_time")
        messages = encode.encode_messages(rows)
        publish_files(messages, f"{root}/topic", None if in_order else files)
    targets = _targets(root, quarantine)
    _ingest(spark, f"{root}/topic", targets, f"{root}/checkpoint")
    return targets


def _stored_readings(targets: IngestTargets, spark: SparkSession) -> DataFrame:
    stored = targets.readings.read(spark)
    return _plain(stored.drop("stream_id", "batch_id", "processing_time", "timestamp"))


@query
def ingested_readings(spark: SparkSession, folder: str) -> DataFrame:
    return _stored_readings(_ingested(spark, folder), spark)


@query
def two_streams_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Two streams with checkpoints of their own write batches of equal numbers
    into the same tables; both keep all their rows."""
    root = scratch_path(spark, "two-streams")
    targets = _targets(root)
    rows = _message_rows(spark, folder)
    for part in (0, 1):
        half = rows.filter(F.col("event_id") % 2 == part)
        half = half.repartitionByRange(_files(half, 2), "row_time")
        publish_files(encode.encode_messages(half), f"{root}/topic-{part}")
        _ingest(spark, f"{root}/topic-{part}", targets, f"{root}/checkpoint-{part}", 2)
    return _stored_readings(targets, spark)


@query
def merged_window_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Every step has parts of every window."""
    stored = _ingested(spark, folder, in_order=False).partials.read(spark)
    return _metric_columns(metrics.merged_window_metrics(stored))


@query
def compacted_window_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the first half compacted after two thirds of the events, their
    batches retired, and the rest, late for these days, stored afterwards."""
    root = scratch_path(spark, "compacted")
    targets, cutoff = _targets(root), _middle(spark, folder)
    rows = _message_rows(spark, folder)
    for part, chosen in (("first", F.col("event_id") % 3 > 0), ("late", F.col("event_id") % 3 == 0)):
        messages = rows.filter(chosen)
        messages = messages.repartitionByRange(_files(messages, 2), "row_time")
        publish_files(encode.encode_messages(messages), f"{root}/topic-{part}")
        _ingest(spark, f"{root}/topic-{part}", targets, f"{root}/checkpoint-{part}", 2)
        if part == "first":
            live = targets.partials.read(spark)
            compaction.compact(live, batch_tables.PARTIALS, f"{root}/closed", cutoff)
            compaction.retire(spark, targets.partials, f"{root}/closed")
    return _metric_columns(compaction.read_metrics(targets.partials.read(spark), f"{root}/closed"))


@query
def ingested_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    targets = _ingested(spark, folder, quarantine=True)
    kept = targets.readings.read(spark).select(F.lit("valid").alias("reason"))
    rejected = targets.quarantine.read(spark).select("reason")
    return kept.unionByName(rejected).groupBy("reason").agg(F.count("*").alias("messages"))


def _event_steps(spark: SparkSession, folder: str, events: DataFrame, path: str) -> int:
    """Write events in steps of rising time, each of as many files, one step after
    the other: streams read files by age. Returns the number of files of a step."""
    count = events.count()
    files = max(2, math.ceil(count / STEPS / FILE_MESSAGES))
    cuts = events.select(F.expr("ts::timestamp").alias("ts")).selectExpr(
        f"approx_percentile(ts, array({', '.join(str(k / STEPS) for k in range(1, STEPS))})) AS cuts"
    ).first()["cuts"] or []
    step = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: F.expr("ts::timestamp") > cut)) if cuts else F.lit(0)
    for number in range(STEPS):
        part = events.filter(step == number)
        part.repartition(files).write.mode("append").parquet(path)
    return files


def _event_stream(spark: SparkSession, path: str, files: int) -> DataFrame:
    stream = spark.readStream.schema(ev.EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    fields = ev.event_fields(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    return enrich.derive(fields).withColumn("processing_time", F.current_timestamp())


@query
def ingested_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Messages offered to a topic with damaged ones, against what the tables hold."""
    targets = _ingested(spark, folder, quarantine=True)
    held = targets.readings.read(spark).agg(F.count("*").alias("readings_held"))
    rejected = targets.quarantine.read(spark).agg(F.count("*").alias("quarantine_held"))
    sums = [F.sum(c).alias(c) for c in ("offered", "readings", "quarantined")]
    told = targets.audit.read(spark).agg(*sums)
    whole = told.withColumns({"readings_held": held.scalar(), "quarantine_held": rejected.scalar()})
    return whole.withColumn("unaccounted", F.expr("offered - readings - quarantined"))


@query
def stream_window_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that the watermark has closed, over the events in steps of rising
    time. The last ones stay open: more rows for them could come."""
    root = scratch_path(spark, "windows")
    files = _event_steps(spark, folder, ev.read_events(spark, folder), f"{root}/events")
    target = batch_tables.PathTable(f"{root}/states", batch_tables.STATES)
    windows.start_windowed(
        _event_stream(spark, f"{root}/events", files),
        target,
        f"{root}/checkpoint",
        trigger={"availableNow": True},
        output_mode="append",
        state_partitions=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    return _metric_columns(windows.latest_windows(target.read(spark)))


@query
def windowed_table_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of all windows from the table of window states. Two streams keep
    states of the same windows, each is stopped after half of its events and started
    again; between the halves, closed days are compacted to their newest states and
    what went in is retired."""
    root = scratch_path(spark, "windowed-table")
    table = batch_tables.PathTable(f"{root}/states", batch_tables.STATES)
    events, cutoff = ev.read_events(spark, folder), _middle(spark, folder)
    for half in ("first", "second"):
        for stream in (0, 1):
            own = F.col("event_id") % 2 == stream
            early = F.col("event_id") % 5 < 3
            part = events.filter(own & (early if half == "first" else ~early))
            files = _event_steps(spark, folder, part, f"{root}/events-{stream}")
            windows.start_windowed(
                _event_stream(spark, f"{root}/events-{stream}", 2 * files),
                table,
                f"{root}/checkpoint-{stream}",
                trigger={"availableNow": True},
                delay="4000 days",
                state_partitions=spark.sparkContext.defaultParallelism,
            ).awaitTermination()
        if half == "first":
            compaction.compact(table.read(spark), table.layout, f"{root}/closed", cutoff)
            compaction.retire(spark, table, f"{root}/closed")
    states = compaction.read_rows(table.read(spark), table.layout, f"{root}/closed")
    return _metric_columns(windows.latest_windows(states))


def _from_catalog(
    spark: SparkSession,
    folder: str,
    layout: batch_tables.TableLayout,
    view: str,
    answer: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The answer from a view over tables that are filled through the catalog sink,
    in a database of their own, which is dropped when the answer is stored."""
    root = scratch_path(spark, "catalog")
    database = f"millpulse_{uuid.uuid4().hex}"
    try:
        ddl.create_tables(spark, database, location=f"{root}/tables")
        ddl.create_views(spark, database)
        rows = enrich.enrich(_events(spark, folder).select(*EVENT.names))
        name = ddl.READING_BATCHES
        if layout is batch_tables.PARTIALS:
            name = ddl.PARTIAL_BATCHES
            rows = metrics.metric_partials(rows).withColumn("window_date", F.to_date("window_start"))
        table = batch_tables.CatalogTable(f"{database}.{name}", layout)
        table.replace_batch(rows, batch_tables.BatchId("check", 0), rebalance=True)
        result = answer(read_table(spark, f"{database}.{view}"))
        result.write.parquet(f"{root}/answer")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return spark.read.schema(result.schema).parquet(f"{root}/answer")


@query
def catalog_readings_in_range(spark: SparkSession, folder: str) -> DataFrame:
    first, last = _days(spark, folder)
    start = dt.datetime.combine(first + (last - first) // 3, dt.time(6))

    def answer(readings: DataFrame) -> DataFrame:
        found = in_time_range(readings, start, start + dt.timedelta(days=2, hours=12))
        return _plain(found.select("event_time", "date", "machine_id", *MEASURES, "time_window"))

    return _from_catalog(spark, folder, batch_tables.READINGS, ddl.READINGS_VIEW, answer)


@query
def catalog_high_fault_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _from_catalog(
        spark, folder, batch_tables.PARTIALS, ddl.METRICS_VIEW,
        lambda view: _rounded(reports.high_fault_windows(view)),
    )


# --- history --------------------------------------------------------------


@query
def snapshot_diff(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events(spark, folder).select("event_id", "temperature_c")
    bounds = ev.read_events(spark, folder).agg(F.max("event_id").alias("m"))
    tenth = bounds.select(F.call_function("div", F.col("m") + 1, F.lit(10)).alias("t")).scalar()
    old = rows.filter(F.col("event_id") < tenth * 9)
    new = rows.filter(F.col("event_id") >= tenth).withColumn(
        "temperature_c",
        F.when(F.col("event_id") % 100 == 0, F.col("temperature_c") + 1).otherwise(
            F.col("temperature_c")
        ),
    )
    return history.snapshot_diff(old, new, ["event_id"], ["temperature_c"])


@query
def evolve_v1_to_v2(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _events(spark, folder).select("event_id", *EVENT.names)
    readings = enrich.enrich(parsed, "event_id")
    v1 = readings.filter(F.col("event_id") % 2 == 0).select("event_id", *READING_V1.names)
    v2 = readings.filter(F.col("event_id") % 2 == 1).select("event_id", *READING.names)
    return _plain(history.unify_readings(v1, v2, "event_id").drop("processing_time"))
