import time

import pytest
from pyspark.sql import functions as F

from millpulse.jobs import main
from millpulse.schemas import AGGREGATE_V1, CSV_COLUMNS, READING_V1
from millpulse.sinks.batch_tables import PARTIALS, READINGS, PathTable, append_table
from millpulse.streaming.windows import latest_windows


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "rows.csv"
    lines = [f"2024-01-01 {h:02d}:00:00,{h}.5,{60 + h}.0,2.0,0.7,36.0,{h % 2}" for h in range(24)]
    path.write_text("\n".join([",".join(CSV_COLUMNS), *lines, "never,1,2,3,4,5,0"]) + "\n")
    return str(path)


def test_from_csv_to_reports(spark, csv, tmp_path, capsys):
    root, topic = str(tmp_path / "tables"), str(tmp_path / "topic")
    main(["publish", "--csv", csv, "--messages", topic, "--rejects", str(tmp_path / "rejects")], spark)
    assert spark.read.json(str(tmp_path / "rejects")).count() == 1
    spark.streams.resetTerminated()
    main(["ingest", "--messages", topic, "--root", root, "--checkpoint", str(tmp_path / "cp"),
          "--once", "--quarantine"], spark)

    def report(name, *options):
        out = str(tmp_path / name)
        main(["report", name, "--root", root, "--output", out, *options], spark)
        return spark.read.parquet(out)

    assert report("temperature_trend").count() == 24
    assert report("hourly_patterns", "--start", "2024-01-01T06:00:00",
                  "--end", "2024-01-01T08:00:00").count() == 2
    assert report("high_fault_windows").count() == 12
    assert report("high_fault_windows", "--start", "2024-01-01T06:00:00",
                  "--end", "2024-01-01T10:00:00").count() == 2
    assert report("profile").count() > 5
    main(["report", "fault_by_machine", "--root", root, "--rows", "5"], spark)
    assert "fault_percentage" in capsys.readouterr().out
    assert report("sample_readings").count() == 20
    main(["sql", "SELECT count(*) AS n FROM sensor_metrics", "--root", root,
          "--output", str(tmp_path / "sql")], spark)
    assert spark.read.parquet(str(tmp_path / "sql")).first()["n"] == 24
    assert not spark.catalog.tableExists("sensor_metrics")  # the caller's session is left as it was
    assert sorted(map(tuple, report("recent_risk_or_fault").collect())) == sorted(
        map(tuple, report("recent_risk_or_fault", "--start", "2023-01-01T00:00:00", "--end", "2025-01-01T00:00:00").collect()))

    def all_reports(*options):
        return [
            sorted(map(tuple, report(name, *options).collect()))
            for name in ("temperature_trend", "fault_by_machine", "hourly_patterns", "high_fault_windows")
        ]

    before, closed = all_reports(), str(tmp_path / "closed")
    compacted = ["--compacted", closed]
    main(["compact", "--root", root, *compacted, "--before", "2024-01-02"], spark)
    assert spark.read.parquet(f"{closed}/readings/days").count() == 24
    assert all_reports(*compacted) == before
    running = PathTable(f"{root}/readings", READINGS).read(spark)  # files are listed now
    main(["compact", "--root", root, *compacted, "--since", "2024-01-01", "--before", "2024-01-02",
          "--retire"], spark)
    assert running.filter("temperature_c > 0").count() == 24
    main(["compact", "--root", root, *compacted, "--since", "2024-01-01", "--before", "2024-01-02",
          "--retire", "--grace-hours", "0"], spark)
    assert spark.read.parquet(f"{closed}/partials/days").count() == 24
    assert report("temperature_trend").count() == 0  # no live batch is left
    assert all_reports(*compacted) == before


def test_views_of_a_statement_shadow_nothing(spark, csv, tmp_path):
    """A view of the database answers after sql has run over other tables."""
    main(["init-tables", "--database", "shadow_test", "--location", str(tmp_path / "db")], spark)
    topic, root = str(tmp_path / "topic"), str(tmp_path / "tables")
    main(["publish", "--csv", csv, "--messages", topic, "--one-header"], spark)
    main(["ingest", "--messages", topic, "--root", root, "--checkpoint", str(tmp_path / "cp"), "--once",
          "--max-bytes-per-trigger", "1k"], spark)
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    spark.sql("USE shadow_test")
    try:
        main(["sql", 'SELECT count(*) AS "n" FROM "sensor_readings"', "--root", root, "--output", str(tmp_path / "n")], spark)
        assert spark.read.parquet(str(tmp_path / "n")).first()["n"] == 24
        for view in ("sensor_readings", "sensor_metrics", "sensor_windows"):
            assert spark.sql(f'SELECT * FROM "{view}"').count() == 0
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
        spark.sql("USE default")
        spark.sql("DROP DATABASE shadow_test CASCADE")


def test_tables_in_a_database(spark, csv, tmp_path):
    main(["init-tables", "--database", "jobs_test", "--location", str(tmp_path / "db")], spark)
    topic = str(tmp_path / "topic")
    for _ in range(2):
        main(["publish", "--csv", csv, "--messages", topic], spark)
    spark.streams.resetTerminated()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        main(["ingest", "--messages", topic, "--database", "jobs_test", "--checkpoint",
              str(tmp_path / "cp"), "--once", "--max-per-trigger", "1"], spark)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert spark.table("jobs_test.sensor_reading_batches").select("batch_id").distinct().count() == 2
    assert spark.table("jobs_test.sensor_readings").count() == 48
    totals = spark.table("jobs_test.sensor_metrics").select("total_readings").collect()
    assert [r[0] for r in totals] == [2] * 24
    spark.sql("DROP DATABASE jobs_test CASCADE")


@pytest.mark.parametrize(
    "line",
    ["ingest --checkpoint x --root y", "ingest --kafka h:1 --checkpoint x --root y",
     "report fault_by_machine --root y", "publish --kafka h:1 --csv x"],
)
def test_arguments_that_are_needed(line, capsys):
    with pytest.raises(SystemExit):
        main(line.split())
    capsys.readouterr()


@pytest.mark.parametrize("monitor", [[], ["--monitor"]])
def test_a_failed_stream_fails_the_job(spark, csv, tmp_path, monkeypatch, monitor, capsys):
    """Also when it has failed before the job waits for it."""
    from millpulse import jobs
    from millpulse.sinks.batch_tables import PathTable

    def fail(self, *args, **kwargs):
        raise RuntimeError("disk is gone")

    def slow_start(*args, **kwargs):
        query = start(*args, **kwargs)
        while query.isActive:
            time.sleep(0.1)
        return query

    start = jobs.start_ingest
    monkeypatch.setattr(PathTable, "replace_batch", fail)
    monkeypatch.setattr(jobs, "start_ingest", slow_start)
    topic = str(tmp_path / "topic")
    main(["publish", "--csv", csv, "--messages", topic], spark)
    with pytest.raises(Exception, match="disk is gone"):
        main(["ingest", "--messages", topic, "--root", str(tmp_path / "t"), "--checkpoint",
              str(tmp_path / "cp"), "--once", *monitor], spark)
    spark.streams.resetTerminated()
    capsys.readouterr()


def test_windows_upgrade_and_diff(spark, csv, tmp_path):
    topic = str(tmp_path / "topic")
    main(["publish", "--csv", csv, "--messages", topic], spark)
    main(["windows", "--messages", topic, "--root", str(tmp_path / "t"), "--checkpoint",
          str(tmp_path / "cp"), "--once", "--state-partitions", "2"], spark)
    states = PathTable(str(tmp_path / "t" / "window_states"), PARTIALS).read(spark)
    assert latest_windows(states).count() == 24
    root, closed, out = str(tmp_path / "t"), str(tmp_path / "closed"), str(tmp_path / "out")
    want = sorted(map(tuple, latest_windows(states).drop("processing_time").collect()))
    for before in ("2024-01-01", "2024-01-02"):
        main(["compact", "--root", root, "--compacted", closed, "--before", before, "--retire", "--grace-hours", "0"], spark)
        main(["sql", "SELECT * EXCEPT (processing_time) FROM sensor_windows", "--root", root, "--compacted", closed,
              "--output", out], spark)
        assert sorted(map(tuple, spark.read.parquet(out).collect())) == want
    assert not list((tmp_path / "t" / "window_states").glob("*/*/*/*.parquet"))
    main(["report", "high_fault_windows", "--windows", "--root", root, "--compacted", closed, "--output", out], spark)
    assert spark.read.parquet(out).count() == 12
    main(["report", "high_fault_windows", "--windows", "--root", root, "--compacted", closed, "--output", out,
          "--start", "2024-01-01T06:00:00", "--end", "2024-01-01T10:00:00"], spark)
    assert spark.read.parquet(out).count() == 2

    main(["init-tables", "--database", "upgrade_test", "--location", str(tmp_path / "db"), "--older"], spark)
    row = {"timestamp": "2024-01-01T00:00:00", "machine_id": "m", "temperature_c": 90.0}
    old = spark.createDataFrame([row], READING_V1).withColumn("event_time", F.to_timestamp("timestamp"))
    append_table(old.withColumn("date", F.to_date("event_time")), "upgrade_test.sensor_readings_v1")
    for _ in range(2):
        main(["upgrade", "--database", "upgrade_test"], spark)
    window = spark.sql("SELECT struct(TIMESTAMP'2023-12-31 10:00:00' AS start, TIMESTAMP'2023-12-31 10:15:00' AS end) AS window")
    aggregates = window.selectExpr(
        "window", "'m' AS machine_id", *(f"1.5D AS {c}" for c in AGGREGATE_V1.names[2:8]), "3 AS fault_count", "4 AS reading_count")
    append_table(aggregates, "upgrade_test.sensor_aggregates")
    main(["upgrade", "--database", "upgrade_test", "--metrics", str(tmp_path / "older")], spark)
    for options, n in (([], 13), (["--start", "2024-01-01T00:00:00"], 12)):
        main(["report", "high_fault_windows", "--windows", "--root", root, "--compacted", closed, "--output", out,
              "--older", str(tmp_path / "older"), *options], spark)
        assert spark.read.parquet(out).count() == n
    new = spark.table("upgrade_test.sensor_readings").collect()
    assert [(r["machine_id"], r["temp_status"]) for r in new] == [("m", "HIGH")]
    spark.sql("DROP DATABASE upgrade_test CASCADE")

    for name, rows in (("a", [(1, 5), (2, 6)]), ("b", [(1, 5), (2, 7), (3, 8)])):
        spark.createDataFrame(rows, "id int, v int").write.parquet(str(tmp_path / name))
    main(["diff", "--old", str(tmp_path / "a"), "--new", str(tmp_path / "b"), "--key", "id",
          "--output", str(tmp_path / "diff")], spark)
    assert {(r["id"], r["change_type"]) for r in spark.read.parquet(str(tmp_path / "diff")).collect()} == {
        (2, "changed"), (3, "added")}
