import random
from collections import Counter

from pyspark.sql import functions as F

from millpulse.operators.enrich import enrich
from millpulse.operators.history import snapshot_diff, unify_readings, upgrade_readings
from millpulse.schemas import EVENT, READING, READING_V1

FIELDS = "k string, a double, b string"


def brute_force(old, new):
    lost, gained = Counter(old) - Counter(new), Counter(new) - Counter(old)
    out = Counter()
    for key in {r[0] for r in [*lost, *gained]}:
        left = [(r, n) for r, n in lost.items() if r[0] == key]
        came = [(r, n) for r, n in gained.items() if r[0] == key]
        if [n for _, n in left] == [1] and [n for _, n in came] == [1]:
            out[(key, "changed", *left[0][0][1:], *came[0][0][1:], 1)] += 1
            continue
        for r, n in left:
            out[(key, "removed", *r[1:], None, None, n)] += 1
        for r, n in came:
            out[(key, "added", None, None, *r[1:], n)] += 1
    return out


def test_diff_equals_brute_force_with_copies_and_unknown_values(spark):
    rng = random.Random(3)

    def table(n):
        return [(rng.choice([None, "hot", "hot", "hot", *"abcdefgh"]), rng.choice([None, 1.0, 2.0]),
                 rng.choice([None, "x"])) for _ in range(n)]

    for n in (0, 5, 200):
        old, new = table(n), table(n)
        # The joined keys must meet whether or not the matched side is broadcast.
        for threshold in ("10485760", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            result = snapshot_diff(
                spark.createDataFrame(old, FIELDS), spark.createDataFrame(new, FIELDS), ["k"], ["a", "b"]
            )
            assert result.columns == ["k", "change_type", "old_a", "old_b", "new_a", "new_b", "copies"]
            assert Counter(tuple(r) for r in result.collect()) == brute_force(old, new)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changed_to_unknown_is_a_change_not_a_removal(spark):
    old = spark.createDataFrame([("a", 1.0, "x")], FIELDS)
    new = spark.createDataFrame([("a", None, "x")], FIELDS)
    assert [tuple(r) for r in snapshot_diff(old, new, ["k"], ["a"]).collect()] == [
        ("a", "changed", 1.0, None, 1)]


def test_both_snapshots_are_shuffled_once(spark, tmp_path):
    for name, shift in (("old", 0), ("new", 1)):
        spark.range(1000).select(
            F.col("id").alias("k"),
            (F.col("id") % 10 + F.when(F.col("id") < 9, shift).otherwise(0)).alias("a"),
        ).write.parquet(str(tmp_path / name))
    result = snapshot_diff(
        spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new")), ["k"], ["a"]
    )
    assert result.filter("change_type = 'changed'").count() == 9
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "ReusedExchange" in final


def readings(spark):
    rows = [("2024-01-01T00:20:00", f"m{i}", 1.0, t, 1.0, 1.0, 1.0, i % 2)
            for i, t in enumerate([90.0, 10.0, 50.0, None])]
    return enrich(spark.createDataFrame(rows, EVENT))


def test_older_readings_gain_the_derived_columns(spark):
    full = readings(spark)
    older = full.select(*READING_V1.names)
    upgraded = upgrade_readings(older)
    assert upgraded.schema.names == READING.names
    assert upgraded.schema["processing_time"].dataType == READING["processing_time"].dataType
    same = [c for c in READING.names if c != "processing_time"]
    assert sorted(upgraded.select(same).collect()) == sorted(full.select(same).collect())
    both = unify_readings(older, full)
    assert both.count() == 8 and both.filter("temp_status is null").count() == 0


def test_files_of_both_versions_in_one_folder(spark, tmp_path):
    full = readings(spark)
    full.select(*READING_V1.names).write.parquet(str(tmp_path / "t"))
    full.write.mode("append").parquet(str(tmp_path / "t"))
    mixed = upgrade_readings(spark.read.schema(READING).parquet(str(tmp_path / "t")))
    assert mixed.groupBy("temp_status").count().orderBy("temp_status").collect() == [
        ("HIGH", 2), ("LOW", 2), ("NORMAL", 4)]
    assert mixed.filter("time_window is null").count() == 0
