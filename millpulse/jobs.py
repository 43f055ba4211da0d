"""Command line, for ``spark-submit`` or ``python -m millpulse.jobs``.

Connection settings come from ``spark-submit --conf`` or from the options
below; none has a built-in value.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.operators import encode, history, profile, reports
from millpulse.operators.enrich import monitor_view
from millpulse.operators.metrics import merged_window_metrics
from millpulse.schemas import METRIC
from millpulse.session import build_session
from millpulse.sinks import compaction, ddl
from millpulse.sinks.batch_tables import (
    AUDITED,
    PARTIALS,
    QUARANTINED,
    READINGS,
    STATES,
    BatchId,
    BatchTable,
    CatalogTable,
    PathTable,
    TableLayout,
)
from millpulse.sinks.messages import publish_files, publish_kafka
from millpulse.sources.csv_rows import read_csv_rows
from millpulse.sources.messages import file_messages, kafka_messages, kafka_options
from millpulse.sources.tables import in_time_range
from millpulse.streaming.ingest import (
    IngestTargets,
    await_any,
    enriched_stream,
    start_ingest,
)
from millpulse.streaming.monitor import start_monitor
from millpulse.streaming.windows import LATE_BOUND, LateRows, latest_windows, start_windowed

READING_REPORTS = {
    "temperature_trend": reports.temperature_trend,
    "fault_by_machine": reports.fault_by_machine,
    "hourly_patterns": reports.hourly_patterns,
    "recent_high_risk": reports.recent_high_risk,
    "recent_risk_or_fault": reports.recent_risk_or_fault,
    "daily_temperature_stats": reports.daily_temperature_stats,
    "profile": profile.profile,
    "approximate_profile": profile.approximate_profile,
    "column_info": profile.column_info,
    "sample_readings": lambda rows: reports.sample_readings(rows, "event_time", "machine_id"),
}
METRIC_REPORTS = {"high_fault_windows": reports.high_fault_windows}
#: Reports of the latest rows, which walk the days of a table from the newest.
NEWEST_FIRST = ("recent_high_risk", "recent_risk_or_fault")


def _table(args, name: str, folder: str, layout: TableLayout) -> BatchTable:
    if args.database:
        branch = getattr(args, "branch", None)
        return CatalogTable(f"{args.database}.{name}", layout, args.versioned, branch)
    return PathTable(f"{args.root.rstrip('/')}/{folder}", layout)


def _tables(args) -> IngestTargets:
    return IngestTargets(
        _table(args, ddl.READING_BATCHES, "readings", READINGS),
        _table(args, ddl.PARTIAL_BATCHES, "partials", PARTIALS),
        _table(args, ddl.QUARANTINE_BATCHES, "quarantine", QUARANTINED)
        if getattr(args, "quarantine", False)
        else None,
        _table(args, ddl.AUDIT_BATCHES, "audit", AUDITED) if getattr(args, "audit", False) else None,
    )


def _states(args) -> BatchTable:
    return _table(args, ddl.WINDOW_STATES, "window_states", STATES)


def _stored(args) -> tuple[tuple[BatchTable, str], ...]:
    """The tables that reports read, and the folder of each."""
    tables = _tables(args)
    return (tables.readings, "readings"), (tables.partials, "partials"), (_states(args), "window_states")


def _messages(spark: SparkSession, args) -> DataFrame:
    if args.kafka:
        options = kafka_options(
            args.kafka,
            args.topic,
            args.starting_offsets,
            max_offsets_per_trigger=args.max_per_trigger,
            min_partitions=args.min_partitions,
        )
        return kafka_messages(spark, options)
    return file_messages(spark, args.messages, args.max_per_trigger, args.max_bytes_per_trigger)


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.every}


def init_tables(spark: SparkSession, args) -> None:
    ddl.create_tables(spark, args.database, args.provider, args.location, args.older)
    if not args.versioned:
        ddl.create_views(spark, args.database)


def _await(spark: SparkSession, args, *queries) -> None:
    """Until the stream is caught up (``--once``) or one of its queries ends. A
    query that failed, even before this call, raises here."""
    if args.once:
        for query in queries:
            query.awaitTermination()
        return
    # Any query that fails ends the job, so a scheduler can start it again.
    await_any(spark)
    for query in queries:
        if not query.isActive:
            query.awaitTermination()


def ingest(spark: SparkSession, args) -> None:
    messages = _messages(spark, args)
    queries = [
        start_ingest(
            messages,
            _tables(args),
            args.checkpoint,
            _trigger(args),
            name="tables",
            backfill=args.backfill,
        )
    ]
    if args.monitor:
        view = monitor_view(enriched_stream(messages))
        queries.append(start_monitor(view, _trigger(args), name="monitor"))
    _await(spark, args, *queries)


def windows(spark: SparkSession, args) -> None:
    """Store window states with a bound on late data."""
    late = LateRows()
    spark.streams.addListener(late)
    try:
        query = start_windowed(
            enriched_stream(_messages(spark, args)),
            _states(args),
            args.checkpoint,
            _trigger(args),
            args.delay,
            output_mode=args.mode,
            state_partitions=args.state_partitions,
            name="windows",
        )
        _await(spark, args, query)
    finally:
        spark.streams.removeListener(late)


def monitor(spark: SparkSession, args) -> None:
    stream = monitor_view(enriched_stream(_messages(spark, args)))
    start_monitor(stream, _trigger(args), rows=args.rows).awaitTermination()


def publish(spark: SparkSession, args) -> None:
    typed = encode.typed_rows(
        read_csv_rows(spark, args.csv, args.one_header), timestamp_format=args.timestamp_format
    )
    rows = encode.accepted_rows(typed)
    rows = encode.assign_machine(rows, args.machines, *rows.columns)
    messages = encode.encode_messages(rows)
    if args.kafka:
        publish_kafka(messages, args.kafka, args.topic)
    else:
        publish_files(messages, args.messages)
    if args.rejects:
        encode.rejected_rows(typed).write.mode("overwrite").json(args.rejects)


def _compacted(args, folder: str) -> str | None:
    return f"{args.compacted.rstrip('/')}/{folder}" if args.compacted else None


def _show(result: DataFrame, args) -> None:
    if args.output:
        result.write.mode("overwrite").parquet(args.output)
    else:
        result.show(args.rows, truncate=False)


def _metrics(rows: DataFrame, layout: TableLayout) -> DataFrame:
    return latest_windows(rows) if layout is STATES else merged_window_metrics(rows)


def report(spark: SparkSession, args) -> None:
    """A named report; rows of compacted days come from the compacted tables. With
    --windows, metrics are those of the stored window states."""
    readings, partials, states = _stored(args)
    of_metrics = args.name in METRIC_REPORTS
    table, folder = (states if args.windows else partials) if of_metrics else readings
    root = _compacted(args, folder)
    if args.name in NEWEST_FIRST and not (args.start or args.end):
        known = {*table.days(spark), *compaction.days(spark, table.layout, root)}
        result = reports.newest_first(
            known,
            lambda since, until: compaction.read_days(spark, table, root, since, until),
            READING_REPORTS[args.name],
            reports.RECENT_LIMIT,
        )
        return _show(result, args)
    if args.start and args.end:
        until = args.end.date() + dt.timedelta(days=1)
        live = table.read_days(spark, args.start.date(), until)
    else:
        live = table.read(spark)
    rows = compaction.read_rows(live, table.layout, root)
    if of_metrics:
        rows = in_time_range(rows, args.start, args.end, "window_start", "window_date")
        found = _metrics(rows, table.layout)
        if args.older:
            older = spark.read.schema(METRIC).parquet(args.older)
            older = older.withColumn("window_date", F.to_date("window_start"))
            older = in_time_range(older, args.start, args.end, "window_start", "window_date")
            found = found.unionByName(older.select(*found.columns))
        result = METRIC_REPORTS[args.name](found)
    else:
        result = READING_REPORTS[args.name](in_time_range(rows, args.start, args.end))
    _show(result, args)


def sql(spark: SparkSession, args) -> None:
    """A statement over the views sensor_readings, sensor_metrics and sensor_windows,
    which live in a session of their own: the caller's names stay what they are."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    ddl.register_views(
        *(
            compaction.read_rows(table.read(session), table.layout, _compacted(args, folder))
            for table, folder in _stored(args)
        )
    )
    _show(session.sql(args.statement), args)


def compact(spark: SparkSession, args) -> None:
    """Closed days into few files; with --retire, delete the live batches they hold
    once they have been listed for the grace period."""
    for table, folder in _stored(args):
        live = (
            table.read(spark) if args.since is None else table.read_days(spark, args.since, args.before)
        )
        root = _compacted(args, folder)
        compaction.compact(live, table.layout, root, args.before, args.since)
        if args.retire:
            compaction.retire(spark, table, root, dt.timedelta(hours=args.grace_hours))


def upgrade(spark: SparkSession, args) -> None:
    """Readings of the older layout into the current table; older aggregates as metrics."""
    target = _table(args, ddl.READING_BATCHES, "readings", READINGS)
    older = history.upgrade_readings(spark.table(f"{args.database}.{ddl.READINGS_V1}"))
    # One batch under a name of its own: done again, it replaces itself.
    target.replace_batch(older, BatchId("upgrade", 0), rebalance=True)
    if args.metrics:
        aggregates = spark.table(f"{args.database}.{ddl.AGGREGATES_V1}")
        history.metrics_from_aggregates(aggregates).write.mode("overwrite").parquet(args.metrics)


def diff(spark: SparkSession, args) -> None:
    """Rows added, removed and changed between two stored states of a table."""
    old, new = (spark.read.parquet(path) for path in (args.old, args.new))
    compare = args.compare or [c for c in old.columns if c in new.columns and c not in args.key]
    _show(history.snapshot_diff(old, new, args.key, compare), args)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millpulse")
    commands = parser.add_subparsers(required=True)

    def command(fn, *groups):
        sub = commands.add_parser(fn.__name__.replace("_", "-"), help=fn.__doc__)
        sub.set_defaults(run=fn)
        for group in groups:
            group(sub)
        return sub

    def stored(sub):
        where = sub.add_mutually_exclusive_group(required=True)
        where.add_argument("--root", help="folder of the parquet tables")
        where.add_argument("--database", help="database of the catalog tables")
        sub.add_argument("--versioned", action="store_true", help="the catalog keeps snapshots")

    def source(sub):
        where = sub.add_mutually_exclusive_group(required=True)
        where.add_argument("--kafka", help="bootstrap servers")
        where.add_argument("--messages", help="folder of message text files")
        sub.add_argument("--topic")

    def shown(sub):
        where = sub.add_mutually_exclusive_group(required=True)
        where.add_argument("--output", help="parquet folder for the whole result")
        where.add_argument("--rows", type=int, help="print so many rows instead")

    def stream(sub):
        sub.add_argument("--starting-offsets", default="latest")
        sub.add_argument("--max-per-trigger", type=int, help="offsets or files of a step")
        sub.add_argument("--max-bytes-per-trigger", help="size of a step's files, such as 10g")
        sub.add_argument("--min-partitions", type=int, help="tasks that read the topic, at least")
        sub.add_argument("--once", action="store_true", help="stop when caught up")

    sub = command(init_tables)
    sub.add_argument("--database", required=True)
    sub.add_argument("--provider", default="parquet")
    sub.add_argument("--location")
    sub.add_argument("--older", action="store_true", help="also the tables of the older layout")
    sub.add_argument("--versioned", action="store_true", help="the catalog keeps snapshots")

    sub = command(ingest, source, stored, stream)
    sub.add_argument("--checkpoint", required=True, help="durable folder")
    sub.add_argument("--every", default="30 seconds")
    sub.add_argument("--quarantine", action="store_true")
    sub.add_argument("--audit", action="store_true", help="a row for each step: messages offered, stored, quarantined")
    sub.add_argument("--backfill", action="store_true", help="steps hold many days at once")
    sub.add_argument("--monitor", action="store_true", help="also print to the console")

    sub = command(windows, source, stored, stream)
    sub.add_argument("--checkpoint", required=True, help="durable folder")
    sub.add_argument("--every", default="30 seconds")
    sub.add_argument("--delay", default=LATE_BOUND, help="how late a row may be")
    sub.add_argument("--mode", choices=["update", "append"], default="update")
    sub.add_argument("--state-partitions", type=int, help="fixed by the first start")

    sub = command(monitor, source, stream)
    sub.add_argument("--every", default="5 seconds")
    sub.add_argument("--rows", type=int, default=20, help="rows shown of each step")

    sub = command(publish, source)
    sub.add_argument("--csv", required=True)
    sub.add_argument("--machines", type=int, default=5)
    sub.add_argument("--timestamp-format")
    sub.add_argument("--rejects", help="folder for rows that could not be read")
    sub.add_argument("--one-header", action="store_true", help="all files have the header of the first")

    sub = command(report, stored, shown)
    sub.add_argument("--branch", help="branch or tag of a versioned catalog")
    sub.add_argument("name", choices=[*READING_REPORTS, *METRIC_REPORTS])
    sub.add_argument("--windows", action="store_true", help="metrics of the stored window states")
    sub.add_argument("--older", help="folder of older aggregates that upgrade --metrics has written")
    sub.add_argument("--start", type=dt.datetime.fromisoformat)
    sub.add_argument("--end", type=dt.datetime.fromisoformat)
    sub.add_argument("--compacted", help="folder that compact has written")

    sub = command(sql, stored, shown)
    sub.add_argument("--branch", help="branch or tag of a versioned catalog")
    sub.add_argument("statement")
    sub.add_argument("--compacted", help="folder that compact has written")

    sub = command(compact, stored)
    sub.add_argument("--compacted", required=True)
    sub.add_argument("--before", type=dt.date.fromisoformat, required=True)
    sub.add_argument("--since", type=dt.date.fromisoformat)
    sub.add_argument("--retire", action="store_true", help="delete live batches that are compacted")
    sub.add_argument("--grace-hours", type=float, default=24.0, help="how long readers may need batches listed as compacted")

    sub = command(upgrade)
    sub.add_argument("--database", required=True)
    sub.add_argument("--versioned", action="store_true", help="the catalog keeps snapshots")
    sub.add_argument("--metrics", help="parquet folder for the older aggregates as metrics")

    sub = command(diff, shown)
    sub.add_argument("--old", required=True)
    sub.add_argument("--new", required=True)
    sub.add_argument("--key", nargs="+", required=True)
    sub.add_argument("--compare", nargs="+", help="columns; default: all that both have")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "kafka", None) and not args.topic:
        parser.error("--kafka needs --topic")
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
