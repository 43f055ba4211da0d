import pytest
import json
import math

from millpulse.operators.encode import (
    accepted_rows,
    assign_machine,
    display_rows,
    encode_messages,
    rejected_rows,
    typed_rows,
)
from millpulse.schemas import CSV_COLUMNS, EVENT
from millpulse.sources.csv_rows import read_csv_rows

HEADER = ",".join(CSV_COLUMNS)


def csv_file(tmp_path, *lines):
    path = tmp_path / "rows.csv"
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_scan_types_and_rejects(spark, tmp_path):
    path = csv_file(
        tmp_path,
        "2024-01-01 00:00:00,1.5,36.6,2.0,0.7,36.0,0",
        "2024-01-01 00:00:01,1.5,hot,2.0,0.7,36.0,0",
        "never,1.5,36.6,2.0,0.7,36.0,0",
        "2024-01-01 00:00:02,,36.6,2.0,0.7,36.0,1.0",
        "2024-01-01 00:00:03,1.5,36.6,2.0,0.7,36.0,",
    )
    typed = typed_rows(read_csv_rows(spark, path))
    good = sorted(accepted_rows(typed).collect())
    assert [(r["vibration_mms"], r["temperature_c"], r["fault_label"]) for r in good] == [
        (1.5, 36.6, 0), (None, 36.6, 1)]
    bad = {r["reject_reason"]: json.loads(r["raw"]) for r in rejected_rows(typed).collect()}
    assert set(bad) == {"temperature_c", "timestamp", "fault_label"}
    assert bad["temperature_c"]["Temperature (°C)"] == "hot"


def test_missing_measure_as_nan(spark, tmp_path):
    path = csv_file(tmp_path, "2024-01-01 00:00:00,,36.6,2.0,0.7,36.0,0")
    row = accepted_rows(typed_rows(read_csv_rows(spark, path), missing_as_nan=True)).first()
    assert math.isnan(row["vibration_mms"])


def test_stated_timestamp_format(spark, tmp_path):
    path = csv_file(tmp_path, "31/12/2024 23:00,1,2,3,4,5,0")
    rows = read_csv_rows(spark, path)
    assert accepted_rows(typed_rows(rows)).count() == 0
    assert accepted_rows(typed_rows(rows, timestamp_format="dd/MM/yyyy HH:mm")).count() == 1


def test_messages_carry_all_fields_in_order(spark, tmp_path):
    path = csv_file(tmp_path, "2024-01-01 00:00:00,1.5,,2.0,0.7,36.0,1")
    rows = assign_machine(accepted_rows(typed_rows(read_csv_rows(spark, path))), 5, "row_time")
    message = json.loads(encode_messages(rows).first()["value"])
    assert list(message) == EVENT.names
    assert message["timestamp"] == "2024-01-01T00:00:00" and message["temperature_c"] is None
    assert "temperature_c" not in json.loads(encode_messages(rows, keep_nulls=False).first()["value"])
    assert display_rows(rows).first()["fault_flag"] == "FAULT"


def test_assignment_is_stable_and_in_range(spark):
    def ids(rows):
        return {r["id"]: r["machine_id"] for r in assign_machine(rows, 5, "id").collect()}

    rows = spark.range(1000)
    first = ids(rows)
    assert first == ids(rows.repartition(7))
    assert set(first.values()) == {f"machine_{i}" for i in range(1, 6)}


def test_columns_are_found_by_name_in_every_file(spark, tmp_path):
    names = list(CSV_COLUMNS)
    cells = dict(zip(names, ["2024-01-01 00:00:00", "1.5", "36.6", "2.0", "0.7", "36.0", "1"]))
    orders = [names, names[::-1], [*names[3:], "More, with comma", *names[:3]]]
    folder = tmp_path / "rows of some files"
    folder.mkdir()
    for i, order in enumerate(orders):
        quoted = ",".join(f'"{n}"' for n in order)
        row = ",".join(cells.get(n, "x") for n in order)
        (folder / f"{i}.csv").write_text(f"{quoted}\n{row}\n", encoding="utf-8")
    (folder / "empty.csv").write_text("")
    rows = read_csv_rows(spark, str(folder)).collect()
    assert [tuple(r) for r in rows] == [tuple(cells[n] for n in names)] * 3
    (folder / "wrong.csv").write_text(",".join(names[1:]) + "\n1,2,3,4,5,6\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Timestamp"):
        read_csv_rows(spark, str(folder))


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    """The number of jobs follows the number of different headers, not of files."""
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n\n" + ",".join(CSV_COLUMNS) + "\n")
    for k in range(40):
        order = [*CSV_COLUMNS] if k % 2 else [*reversed(CSV_COLUMNS), "more"]
        cells = {name: str(i) for i, name in enumerate(CSV_COLUMNS)}
        lines = [",".join(order), *[",".join(cells.get(c, "x") for c in order)] * 3]
        (folder / f"part {k}.csv").write_text("\n".join(lines) + "\n")
    tracker, group = spark.sparkContext.statusTracker(), "csv-headers"
    spark.sparkContext.setJobGroup(group, group)
    try:
        rows = read_csv_rows(spark, str(folder))
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 8
    assert {tuple(r) for r in rows.collect()} == {tuple(str(i) for i in range(len(CSV_COLUMNS)))} and rows.count() == 120
    assert read_csv_rows(spark, str(folder / "part 1.csv"), one_header=True).count() == 3
