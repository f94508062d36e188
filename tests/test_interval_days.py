"""Interval logs stored by day and reach: what is read for a range, and that nothing is lost."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import HourRange, state_seconds_by_hour
from hourgrid.plans import MachineLogs
from hourgrid.sources import read_intervals, within_days, write_intervals

SCHEMA = "id long, machine string, state string, start timestamp, end timestamp"
MIDNIGHT = datetime(2024, 3, 10)
DAYS = [0, 0, 0, 0.2, 0.9, 1, 1.5, 2, 2.1, 3, 4, 4.01, 7, 8, 20, 63.9]
ODD = [
    (1001, "m1", "on", None, MIDNIGHT), (1002, "m1", "on", MIDNIGHT, None), (1003, "m1", "on", None, None),
    (1004, "m1", "on", MIDNIGHT, MIDNIGHT - timedelta(days=9)), (1005, "m1", "on", MIDNIGHT, MIDNIGHT),
    (1006, "m1", "on", MIDNIGHT - timedelta(days=1), MIDNIGHT),  # up to midnight
    (1007, "m1", "on", MIDNIGHT - timedelta(days=1), MIDNIGHT + timedelta(seconds=1)),
    (1007, "m1", "on", MIDNIGHT - timedelta(days=1), MIDNIGHT + timedelta(seconds=1)),  # a repeated row
    (1008, None, None, MIDNIGHT, MIDNIGHT + timedelta(hours=5)),
]


@pytest.fixture(scope="module")
def log(spark):
    dice = random.Random(5)
    rows = []
    for i in range(600):
        start = datetime(2024, 1, 1) + timedelta(seconds=dice.randrange(120 * 86400))
        end = start + timedelta(days=dice.choice(DAYS), seconds=dice.randrange(3600))
        rows.append((i, f"m{i % 4}", dice.choice(["on", "off"]), start, end))
    return spark.createDataFrame(rows + ODD, SCHEMA).cache()


@pytest.fixture(scope="module")
def folder(log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("log") / "intervals")
    write_intervals(log, path, start="start", end="end")
    return path


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def seconds(rows, hours):
    return state_seconds_by_hour(
        rows, {"on": ["on"], "off": ["off"]}, keys=["machine"], start="start", end="end", state="state", hours=hours
    )


def read_files(rows):
    return {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}


def test_nothing_is_lost_in_writing(spark, log, folder):
    back = read_intervals(spark, folder, SCHEMA)
    assert back.columns == log.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, log.collect()))


@pytest.mark.parametrize("first, last", [
    ("2024-03-10", "2024-03-10 23:00"), ("2024-01-01", "2024-01-01"), ("2024-03-09 23:00", "2024-03-10"),
    ("2024-02-11", "2024-02-20"), ("2024-07-01", "2024-07-02"), ("2023-12-01", "2024-12-31"),
])
def test_pruned_and_whole_logs_give_the_same(spark, log, folder, first, last):
    hours = HourRange.between(first, last)
    pruned = seconds(read_intervals(spark, folder, SCHEMA, hours=hours), hours)
    assert sorted(map(str, pruned.collect())) == sorted(map(str, seconds(log, hours).collect()))


def test_a_day_reads_only_the_days_that_reach_it(spark, log, folder):
    hours = HourRange.between("2024-03-10", "2024-03-10 23:00")
    rows = read_intervals(spark, folder, SCHEMA, hours=hours)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: (\[.*\]), PushedFilters", plan)
    assert "day" in filters and "<=" in filters and ">=" in filters and "reach_days" in filters
    files = read_files(rows)
    for file in files:
        day, reach = re.search(r"day=([^/]*)/reach_days=(\d+)", file).groups()
        assert date.fromisoformat(day) <= date(2024, 3, 10) <= date.fromisoformat(day) + timedelta(days=int(reach))
    every = read_files(read_intervals(spark, folder, SCHEMA))
    assert 0 < len(files) < len(every) / 5


def test_reach_is_enough_and_less_than_twice_the_days(spark, folder):
    rows = spark.read.parquet(folder).filter("end > start").select(
        "id", "reach_days", F.expr("datediff(to_date(end - interval 1 second), day) AS days")
    )
    for r in rows.collect():
        assert r.days <= r.reach_days <= max(1, 2 * r.days - 1), r


def test_a_declared_reach_prunes_both_sides(spark, log, folder):
    hours = HourRange.between("2024-03-10", "2024-03-11")
    stored = spark.read.parquet(folder)
    kept = within_days(stored, "day", hours, spans=True, reach=64)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    (filters,) = re.findall(r"PartitionFilters: (\[.*\]), PushedFilters", plan)
    assert "<=" in filters and ">=" in filters
    assert sorted(map(str, seconds(kept.select(log.columns), hours).collect())) == sorted(
        map(str, seconds(log, hours).collect())
    )
    assert within_days(stored, "day", hours, spans=True).count() > kept.count()


def test_columns_of_the_names_used_are_refused(log, tmp_path):
    for name in ("day", "Reach_Days"):
        with pytest.raises(ValueError, match="columns of its own"):
            write_intervals(log.withColumn(name, F.lit(1)), str(tmp_path / "x"), start="start", end="end")


def test_an_empty_log(spark, log, tmp_path):
    write_intervals(log.limit(0), str(tmp_path / "none"), start="start", end="end")
    hours = HourRange.between("2024-03-10", "2024-03-11")
    assert read_intervals(spark, str(tmp_path / "none"), SCHEMA, hours=hours).count() == 0


def test_machine_logs_from_folders_with_reach(spark, tmp_path):
    """The states of one day, some of which began long before."""
    instant = datetime(2024, 3, 10, 4)
    states = [
        (1, "sorting", "S", "M1", instant - timedelta(days=30), instant),
        (2, "blocked", "S", "M1", instant, instant + timedelta(minutes=5)),
        (3, "sorting", "S", "M1", instant - timedelta(days=30), instant - timedelta(days=29)),
    ]
    frame = spark.createDataFrame(
        states, "id long, state string, meta_orb_site string, meta_machine_name string, start_time timestamp, end_time timestamp"
    )
    paths = {name: str(tmp_path / name) for name in ("sites", "machines", "states", "attempts", "unloads", "unload_items")}
    write_intervals(frame, paths["states"], start="start_time", end="end_time")
    spark.createDataFrame([("S", "Europe/London")], "meta_orb_site string, timezone string").write.parquet(paths["sites"])
    spark.createDataFrame([("S", "M1")], "meta_orb_site string, meta_machine_name string").write.parquet(paths["machines"])
    for name in ("attempts", "unloads"):
        frame.withColumn("day", F.to_date("start_time")).write.partitionBy("day").parquet(paths[name])
    frame.write.parquet(paths["unload_items"])
    hours = HourRange.between("2024-03-10", "2024-03-10 23:00")
    logs = MachineLogs.from_parquet(spark, hours=hours, reach="reach_days", **paths)
    found = {r.id for r in logs.states.collect()}
    assert found == {1, 2}
    assert {r.id for r in MachineLogs.from_parquet(spark, hours=hours, **paths).states.collect()} == {1, 2, 3}
