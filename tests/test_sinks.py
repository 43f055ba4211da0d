import datetime as dt

import pytest
from pyspark.sql import functions as F

from millpulse.operators import reports
from millpulse.operators.enrich import enrich
from millpulse.operators.metrics import merged_window_metrics, metric_partials, window_metrics
from millpulse.schemas import EVENT, METRIC, READING, READING_V1
from millpulse.sinks import compaction, ddl
from millpulse.sinks.batch_tables import (
    PARTIALS,
    READINGS,
    STATES,
    BatchId,
    CatalogTable,
    PathTable,
    append_table,
    batch_ranges,
)
from millpulse.sources.tables import in_time_range, read_table
from millpulse.streaming.windows import latest_windows

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


def readings(spark, n=90, offset=0):
    rows = [
        (f"{DAYS[i % 3]}T{i % 24:02d}:{i % 60:02d}:00", f"m{i % 4}", float(i % 12), float(i),
         i / 33.0, None, None, i % 2)
        for i in range(offset, offset + n)
    ]
    return enrich(spark.createDataFrame(rows, EVENT))


def batch(number, stream="s"):
    return BatchId(stream, number)


def with_day(partials):
    return partials.withColumn("window_date", F.to_date("window_start"))


def same_rows(a, b):
    columns = [c for c in a.columns if c != "processing_time"]
    assert sorted(map(repr, a.select(columns).collect())) == sorted(map(repr, b.select(columns).collect()))


@pytest.fixture
def filled(spark, tmp_path):
    live = PathTable(str(tmp_path / "readings"), READINGS), PathTable(str(tmp_path / "partials"), PARTIALS)
    for number, offset in enumerate((0, 30, 60)):
        part = readings(spark, 30, offset)
        live[0].replace_batch(part, batch(number))
        live[1].replace_batch(with_day(metric_partials(part)), batch(number))
    return live


def test_replaying_a_batch_replaces_it(spark, filled):
    table, partials = filled
    for _ in range(2):
        table.replace_batch(readings(spark, 30, 30), batch(1))
        partials.replace_batch(with_day(metric_partials(readings(spark, 30, 30))), batch(1))
    same_rows(table.read(spark).drop("stream_id", "batch_id"), readings(spark))
    same_rows(merged_window_metrics(partials.read(spark)), window_metrics(readings(spark)))


def test_files_are_snappy_parquet_in_day_and_batch_folders(filled, tmp_path):
    files = list((tmp_path / "readings").glob("date=2024-01-01/stream_id=s/batch_id=0/*.snappy.parquet"))
    assert files and not list((tmp_path / "readings").glob("*.parquet"))


def test_rows_without_a_time_are_kept(spark, tmp_path):
    table = PathTable(str(tmp_path / "t"), READINGS)
    table.replace_batch(enrich(spark.createDataFrame([("garbage", "m", *[None] * 6)], EVENT)), batch(0))
    assert table.read(spark).filter("date is null").count() == 1


def test_reading_some_days_lists_only_their_folders(spark, filled, database):
    catalog = CatalogTable(f"{database}.{ddl.READING_BATCHES}", READINGS)
    since, until = dt.date(2024, 1, 2), dt.date(2024, 1, 20)
    undated = enrich(spark.createDataFrame([("garbage", "m", *[None] * 6)], EVENT))
    for table in (filled[0], catalog):
        table.replace_batch(readings(spark).unionByName(undated), batch(9))
        found = table.read_days(spark, since, until)
        want = table.read(spark).filter("date is null or date >= '2024-01-02'")
        same_rows(found.select(*READING.names, "batch_id"), want.select(*READING.names, "batch_id"))
    listed = filled[0].read_days(spark, since, until).inputFiles()
    assert listed and not any("2024-01-01" in f for f in listed)


def test_days_without_rows_and_long_ranges(spark, filled, tmp_path):
    table = filled[0]
    none = table.read_days(spark, dt.date(2023, 1, 1), dt.date(2023, 1, 9))
    assert none.count() == 0 and none.schema.names == table.read(spark).schema.names
    assert PathTable(str(tmp_path / "absent"), READINGS).read_days(
        spark, dt.date(2024, 1, 1), dt.date(2024, 1, 2)).count() == 0
    same_rows(table.read_days(spark, dt.date(2020, 1, 1), dt.date(2024, 1, 2)),
              table.read(spark).filter("date < '2024-01-02'"))


def test_streams_do_not_replace_each_other(spark, tmp_path, database):
    """Batches of equal number from two checkpoints; a replay replaces its own only."""
    for table in (PathTable(str(tmp_path / "t"), READINGS),
                  CatalogTable(f"{database}.{ddl.READING_BATCHES}", READINGS)):
        table.replace_batch(readings(spark, 60), batch(0, "a"))
        table.replace_batch(readings(spark, 30, 60), batch(0, "b"))
        table.replace_batch(readings(spark, 60), batch(0, "a"))
        same_rows(table.read(spark).drop("stream_id", "batch_id"), readings(spark))


def test_writing_a_batch_does_not_shuffle(spark, tmp_path):
    from millpulse.sinks.batch_tables import _stored

    plan = _stored(readings(spark), READINGS, batch(0), False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort [date" in plan


def test_rebalanced_batch_has_one_small_file_per_day(spark, tmp_path):
    table = PathTable(str(tmp_path / "t"), READINGS)
    table.replace_batch(readings(spark).repartition(6), batch(0), rebalance=True)
    assert len(list((tmp_path / "t").glob("*/*/*/*.parquet"))) == len(DAYS)
    same_rows(table.read(spark).drop("stream_id", "batch_id"), readings(spark))


def test_compaction_changes_files_but_not_results(spark, filled, tmp_path):
    table, partials = filled
    cutoff = dt.date(2024, 1, 3)
    # A row without a time stays readable after compaction.
    table.replace_batch(enrich(spark.createDataFrame([("garbage", "m", *[None] * 6)], EVENT)), batch(3))
    closed, merged = str(tmp_path / "closed"), str(tmp_path / "merged")
    before = table.read(spark).drop("stream_id", "batch_id")
    for _ in range(2):
        compaction.compact(table.read(spark), READINGS, closed, cutoff)
        compaction.compact(partials.read(spark), PARTIALS, merged, cutoff)
    same_rows(compaction.read_rows(table.read(spark), READINGS, closed), before)
    result = compaction.read_metrics(partials.read(spark), merged)
    assert result.schema.names == METRIC.names
    same_rows(result, window_metrics(readings(spark)))
    folders = {p.parent.parent.name for p in (tmp_path / "merged" / "days").glob("*/*/*.parquet")}
    assert folders == {"window_date=2024-01-01", "window_date=2024-01-02"}
    # The second time there was nothing new to compact.
    assert {p.parent.name for p in (tmp_path / "merged" / "days").glob("*/*/*.parquet")} == {"generation=1"}


@pytest.mark.parametrize("retired", [False, True])
def test_late_rows_count_at_once_and_after_compacting_again(spark, filled, tmp_path, retired):
    table, partials = filled
    cutoff, roots = dt.date(2024, 1, 3), (str(tmp_path / "closed"), str(tmp_path / "merged"))

    def both(fn, *args):
        for stored, root in zip((table, partials), roots):
            fn(stored, root, *args)

    def compact(stored, root, since=None):
        compaction.compact(stored.read(spark), stored.layout, root, cutoff, since)
        if retired:
            compaction.retire(spark, stored, root)

    def check(n):
        same_rows(compaction.read_metrics(partials.read(spark), roots[1]), window_metrics(readings(spark, n)))
        rows = compaction.read_rows(table.read(spark), READINGS, roots[0])
        same_rows(rows, readings(spark, n))

    both(compact)
    check(90)
    late = readings(spark, 30, 90)
    table.replace_batch(late, batch(0, "other"))
    partials.replace_batch(with_day(metric_partials(late)), batch(0, "other"))
    check(120)
    both(compact, dt.date(2024, 1, 1))
    check(120)
    live_days = {str(r[0]) for r in table.read(spark).select("date").distinct().collect()}
    assert live_days == ({"2024-01-03"} if retired else set(DAYS))


def test_a_generation_without_its_list_is_not_read(spark, filled, tmp_path, monkeypatch):
    """A compaction that stops before the last step changes nothing."""
    partials, root = filled[1], str(tmp_path / "merged")
    rows = compaction._compacted
    compaction.compact(partials.read(spark), PARTIALS, root, dt.date(2024, 1, 2))
    stray = rows(spark, PARTIALS, root).withColumn("generation", F.lit(9))
    stray.write.mode("append").partitionBy("window_date", "generation").parquet(f"{root}/days")
    same_rows(compaction.read_metrics(partials.read(spark), root), window_metrics(readings(spark)))


def test_retiring_in_a_catalog(spark, database, tmp_path):
    fill(spark, database)
    table = CatalogTable(f"{database}.{ddl.READING_BATCHES}", READINGS)
    root = str(tmp_path / "closed")
    compaction.compact(table.read(spark), READINGS, root, dt.date(2024, 1, 3))
    assert compaction.retire(spark, table, root) == 6
    assert {str(r[0]) for r in table.read(spark).select("date").distinct().collect()} == {"2024-01-03"}
    same_rows(compaction.read_rows(table.read(spark), READINGS, root), readings(spark))


@pytest.fixture
def database(spark, tmp_path):
    name = "sinks_test"
    ddl.create_tables(spark, name, location=str(tmp_path / "db"), older=True)
    ddl.create_views(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_are_created_once(spark, database, tmp_path):
    names = ddl.create_tables(spark, database, location=str(tmp_path / "db"), older=True)
    assert len(names) == 7
    assert spark.table(f"{database}.sensor_readings").schema.names == READING.names
    assert spark.table(f"{database}.sensor_metrics").schema.names == METRIC.names
    assert [f.dataType for f in spark.table(f"{database}.sensor_metrics").schema] == [
        f.dataType for f in METRIC]
    window = spark.table(f"{database}.sensor_aggregates").schema["window"].dataType
    assert window.names == ["start", "end"]
    assert "spark_catalog" in [r[0] for r in ddl.list_catalogs(spark).collect()]


def test_table_statement_for_a_versioned_catalog():
    text = ddl.create_table_sql("lake.db.t", READING_V1, ("date",), provider="iceberg")
    assert "USING iceberg" in text and "'write.format.default' = 'parquet'" in text
    assert "'write.parquet.compression-codec' = 'snappy'" in text
    assert "PARTITIONED BY (date)" in text and "CREATE TABLE IF NOT EXISTS" in text


def fill(spark, database):
    table = CatalogTable(f"{database}.{ddl.READING_BATCHES}", READINGS)
    partials = CatalogTable(f"{database}.{ddl.PARTIAL_BATCHES}", PARTIALS)
    for number, offset in ((0, 0), (1, 30), (2, 60), (1, 30)):
        part = readings(spark, 30, offset)
        table.replace_batch(part, batch(number))
        partials.replace_batch(with_day(metric_partials(part)), batch(number))


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_catalog_tables_replace_batches(spark, database, session_mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        fill(spark, database)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    same_rows(spark.table(f"{database}.sensor_readings"), readings(spark))
    same_rows(spark.table(f"{database}.sensor_metrics"), window_metrics(readings(spark)))
    pruned = in_time_range(read_table(spark, f"{database}.sensor_readings"), dt.datetime(2024, 1, 3))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_quoted_report_sql_runs_on_the_views(spark, database):
    """SQL in the style of a BI client: double-quoted names, views as tables."""
    fill(spark, database)
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    spark.sql(f"USE {database}")
    try:
        hours = spark.sql(
            'SELECT "hour", AVG("temperature_c") AS avg_temperature, '
            "SUM(CASE WHEN is_fault THEN 1 ELSE 0 END) AS fault_count "
            'FROM "sensor_readings" GROUP BY "hour" ORDER BY "hour"'
        )
        want = reports.hourly_patterns(readings(spark)).select("hour", "avg_temperature", "fault_count")
        same_rows(hours, want)
        windows = spark.sql(
            "SELECT machine_id, window_start, window_end, avg_temperature, max_vibration, "
            "fault_percentage, total_readings FROM sensor_metrics WHERE fault_percentage > 10"
        )
        same_rows(windows, reports.high_fault_windows(window_metrics(readings(spark))))
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
        spark.sql("USE default")


def test_session_views_over_path_tables(spark, filled):
    table, partials = filled
    ddl.register_views(table.read(spark), partials.read(spark))
    assert spark.table("sensor_readings").schema.names == READING.names
    same_rows(spark.table("sensor_metrics"), window_metrics(readings(spark)))
    spark.catalog.dropTempView("sensor_readings")
    spark.catalog.dropTempView("sensor_metrics")


def test_plain_append_matches_names(spark, database):
    older = readings(spark, 10).select(*reversed(READING_V1.names))
    for _ in range(2):
        append_table(older, f"{database}.{ddl.READINGS_V1}")
    stored = spark.table(f"{database}.{ddl.READINGS_V1}")
    assert stored.count() == 20 and stored.filter("machine_id like 'm%'").count() == 20


def state_rows(spark, *rows):
    """Window states (hour of day, machine, total) as parts."""
    return metric_partials(readings(spark)).limit(0).unionByName(
        spark.createDataFrame(
            [(dt.datetime(2024, 1, day, hour), machine, total) for day, hour, machine, total in rows],
            "window_start timestamp, machine_id string, total_readings long",
        ).withColumn("window_end", F.expr("window_start + INTERVAL 15 minutes")),
        allowMissingColumns=True,
    )


def test_compacted_states_keep_the_newest_of_each_stream(spark, tmp_path):
    table, root = PathTable(str(tmp_path / "states"), STATES), str(tmp_path / "closed")

    def store(stream, number, *rows):
        table.replace_batch(with_day(state_rows(spark, *rows)), batch(number, stream))

    def totals():
        found = latest_windows(compaction.read_rows(table.read(spark), STATES, root))
        return {(r.window_start.day, r.machine_id): r.total_readings for r in found.collect()}

    store("a", 0, (1, 5, "m", 3), (2, 5, "m", 1))
    store("a", 1, (1, 5, "m", 4), (2, 5, "m", 6))
    store("b", 0, (1, 5, "m", 10), (1, 5, "n", 2))
    want = {(1, "m"): 14, (1, "n"): 2, (2, "m"): 6}
    assert totals() == want
    for _ in range(2):
        compaction.compact(table.read(spark), STATES, root, dt.date(2024, 1, 2))
        assert totals() == want
        compaction.retire(spark, table, root)
        assert totals() == want
    assert len(spark.read.parquet(f"{root}/days").collect()) == 3
    store("a", 2, (1, 5, "m", 5))  # a late row of stream a
    store("b", 1, (1, 5, "n", 3), (2, 5, "m", 1))
    want = {(1, "m"): 15, (1, "n"): 3, (2, "m"): 7}
    assert totals() == want
    compaction.compact(table.read(spark), STATES, root, dt.date(2024, 1, 3))
    assert totals() == want


def test_view_of_window_states(spark, database):
    table = CatalogTable(f"{database}.{ddl.WINDOW_STATES}", STATES)
    for number, total in ((0, 3), (1, 7)):
        table.replace_batch(with_day(state_rows(spark, (1, 5, "m", total))), batch(number, "a"))
    table.replace_batch(with_day(state_rows(spark, (1, 5, "m", 5))), batch(0, "b"))
    view = spark.table(f"{database}.sensor_windows")
    assert view.schema.names == METRIC.names and [r.total_readings for r in view.collect()] == [12]


def test_batches_are_listed_first_and_deleted_after_the_grace_period(spark, filled, tmp_path):
    table, root = filled[0], str(tmp_path / "closed")
    now, day = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc), dt.timedelta(days=1)
    running = table.read(spark)
    compaction.compact(table.read(spark), READINGS, root, dt.date(2024, 1, 2))
    assert compaction.retire(spark, table, root, day, now) == 0
    compaction.compact(table.read(spark), READINGS, root, dt.date(2024, 1, 3))
    assert compaction.retire(spark, table, root, day, now + day / 2) == 0
    same_rows(running.drop("stream_id", "batch_id"), readings(spark))  # its files are still there
    assert compaction.retire(spark, table, root, day, now + day) == 3
    assert compaction.retire(spark, table, root, day, now + 2 * day) == 3
    assert compaction.retire(spark, table, root, day, now + 3 * day) == 0
    same_rows(compaction.read_rows(table.read(spark), READINGS, root), readings(spark))


def test_ten_thousand_batches_are_retired_in_bulk(spark, tmp_path):
    table, root = PathTable(str(tmp_path / "t"), READINGS), str(tmp_path / "closed")
    table.replace_batch(readings(spark, 3).filter("date = '2024-01-01'").coalesce(1), batch(0, "a:b"))
    (file,) = (tmp_path / "t").glob("*/*/*/*.parquet")
    for number in range(1, 10_000):
        folder = file.parent.parent / f"batch_id={number}"
        folder.mkdir()
        (folder / "part.parquet").hardlink_to(file)
    contents = spark.range(10_000).selectExpr(
        "DATE'2024-01-01' AS date", "'a:b' AS stream_id", "id AS batch_id", "1L AS generation")
    contents.coalesce(1).write.parquet(f"{root}/contents")
    assert compaction.retire(spark, table, root) == 10_000
    assert not list((tmp_path / "t").glob("*/*/batch_id=*"))


def test_ranges_of_batches():
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    many = [(day, "s", n) for n in range(10_000) if n != 77] + [(other, "s", 3), (day, "r", 3), (day, "r", 4)]
    assert sorted(batch_ranges(reversed(many))) == [
        ("r", day, 3, 4), ("s", day, 0, 76), ("s", day, 78, 9999), ("s", other, 3, 3)]


def test_latest_rows_read_the_newest_days_only(spark, tmp_path, database):
    rows = [(f"2024-01-{d:02d}T0{h}:00:00", f"m{h}", 90.0 if d < 29 or h else 5.0, 1.0, 1.0, None, None, 0)
            for d in range(1, 31) for h in range(3)]
    rows += [("garbage", "undated", 95.0, 1.0, 1.0, None, None, 0)]
    data = enrich(spark.createDataFrame(rows, EVENT))
    for table in (PathTable(str(tmp_path / "t"), READINGS), CatalogTable(f"{database}.{ddl.READING_BATCHES}", READINGS)):
        assert table.days(spark) == []
        table.replace_batch(data, batch(0))
        assert table.days(spark) == [dt.date(2024, 1, d) for d in range(1, 31)]
        for limit, days in ((2, 1), (3, 4), (10, 4), (14, 16), (1000, 30)):
            read = []

            def days_read(since, until):
                read.append((since, until))
                return table.read_days(spark, since, until)

            found = reports.newest_first(
                table.days(spark), days_read, lambda r: reports.recent_high_risk(r, limit), limit)
            assert (read[-1][1] - read[-1][0]).days == days
            assert found.collect() == reports.recent_high_risk(table.read(spark), limit).collect()
    listed = table.read_days(spark, *read[0]).inputFiles()
    assert listed and all("2024-01-30" in f or "__HIVE" in f for f in listed)
    assert reports.newest_first([], lambda *_: data, lambda r: reports.recent_high_risk(r), 50).count() > 0
