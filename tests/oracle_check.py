"""Run registered queries in Spark and their SQL in DuckDB, and compare."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def oracle_rows(sql: str, folder: str):
    with duckdb.connect() as db:
        for file in Path(folder).glob("*.parquet"):
            db.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        result = db.execute(sql)
        columns = [c[0] for c in result.description]
        return columns, result.fetchall()


def spark_rows(frame):
    return frame.columns, [tuple(r) for r in frame.collect()]


def compare(spark, query, sql, folder) -> str | None:
    """None when equal, else what differs."""
    columns, rows = spark_rows(query(spark, folder))
    if sql is None:
        return None if rows else "no rows"
    expected_columns, expected = oracle_rows(sql, folder)
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} / {sorted(expected_columns)}"
    got, want = rows_of(columns, rows), rows_of(expected_columns, expected)
    if got != want:
        return (
            f"rows {len(rows)} / {len(expected)}; only Spark {list((got - want).items())[:2]}; "
            f"only SQL {list((want - got).items())[:2]}"
        )
    return None


def main(folders, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry.oracle_sql()
    bad = 0
    for folder in folders:
        for name, query in entry.queries().items():
            if names and name not in names:
                continue
            start = time.time()
            try:
                problem = compare(spark, query, oracle.get(name), folder)
            except Exception as error:  # report every query, then fail
                problem = f"{type(error).__name__}: {str(error)[:600]}"
            bad += problem is not None
            print(f"{folder[-8:]:>9} {name:28} {time.time() - start:6.1f}s "
                  f"{'rows-only ' if name not in oracle else ''}{problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main([a for a in args if "/" in a], [a for a in args if "/" not in a]) and 1)
