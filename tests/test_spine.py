from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import require_utc
from hourgrid.operators import (
    HourRange,
    duplicate_keys,
    entity_hour_grid,
    entity_registry,
    hour_spine,
    hour_spine_over,
)

REGISTRY = "site string, machine string, timezone string"


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc).replace(tzinfo=None)


def test_range_has_both_ends():
    hours = HourRange.between("2022-11-01", "2023-03-31")
    assert hours.count == 3601
    assert HourRange.between("2022-11-01 05:00", "2022-11-01 05:00").count == 1
    assert HourRange.between("2022-11-01 05:30", "2022-11-01 07:29").count == 2


def test_range_takes_text_datetimes_and_offsets():
    text = HourRange.between("2024-01-01", "2024-01-02")
    assert text == HourRange.between(datetime(2024, 1, 1), datetime(2024, 1, 2))
    assert text == HourRange.between("2024-01-01 05:30+05:30", "2024-01-01T19:00-05:00")


def test_range_must_not_be_reversed():
    with pytest.raises(ValueError):
        HourRange.between("2024-01-02", "2024-01-01")


@pytest.mark.parametrize(
    "instant, first, count",
    [
        ("2023-12-25", "2024-01-01 00:00", 25),
        ("2024-01-01 05:00", "2024-01-01 05:00", 20),
        ("2024-01-01 05:01", "2024-01-01 06:00", 19),
        ("2024-01-02", "2024-01-02 00:00", 1),
    ],
)
def test_since(instant, first, count):
    part = HourRange.between("2024-01-01", "2024-01-02").since(instant)
    assert (part.first, part.count) == (HourRange.between(first, first).first, count)


def test_since_past_the_end():
    with pytest.raises(ValueError):
        HourRange.between("2024-01-01", "2024-01-02").since("2024-01-02 00:01")


def test_spine_rows(spark):
    rows = hour_spine(spark, HourRange.between("2022-12-31 22:00", "2023-01-01 01:00")).collect()
    assert [row.id_hours for row in rows] == [0, 1, 2, 3]
    assert rows[2].start_time == utc(2023, 1, 1)
    assert rows[2].end_time == utc(2023, 1, 1, 0, 59, 59)
    assert rows[2].date_hour == "2023-01-01 00"


def test_spine_and_grid_before_1970(spark):
    hours = HourRange.between("1969-12-31 22:30", "1970-01-01 00:30")
    registry = spark.createDataFrame([("A", "M0", "UTC")], REGISTRY)
    grid = entity_hour_grid(registry, hours, ["site", "machine"]).drop(*registry.columns)
    labels = [(row.id_hours, row.date_hour) for row in hour_spine(spark, hours).orderBy("id_hours").collect()]
    assert labels == [(0, "1969-12-31 22"), (1, "1969-12-31 23"), (2, "1970-01-01 00")]
    assert sorted(grid.collect()) == sorted(hour_spine(spark, hours).collect())


def test_spine_ids_do_not_depend_on_partitions(spark, monkeypatch):
    from hourgrid.operators import spine

    hours = HourRange.between("2024-01-01", "2024-01-05")
    one = hour_spine(spark, hours)
    monkeypatch.setattr(spine, "SPINE_ROWS_PER_TASK", 10)
    many = hour_spine(spark, hours)
    assert one.rdd.getNumPartitions() == 1
    assert many.rdd.getNumPartitions() == 10
    assert sorted(one.collect()) == sorted(many.collect())


def test_spine_over_a_log(spark):
    log = spark.sql(
        "SELECT * FROM VALUES (timestamp '2024-01-01 10:59:59.9'), (null), "
        "(timestamp '2024-01-01 13:00:00') AS t(ts)"
    )
    rows = hour_spine_over(log, "ts").collect()
    assert [(row.id_hours, row.date_hour) for row in rows] == [
        (i, f"2024-01-01 {10 + i}") for i in range(4)
    ]
    assert hour_spine_over(log.filter("false"), "ts").count() == 0


def test_grid_is_dense(spark):
    registry = spark.createDataFrame(
        [("A", f"M{i}", "UTC") for i in range(3)] + [("B", "M0", "UTC")], REGISTRY
    )
    hours = HourRange.between("2024-01-01 03:00", "2024-01-04 01:00")
    grid = entity_hour_grid(registry, hours, ["site", "machine"])
    spine = hour_spine(spark, hours)
    expected = {(*entity, *row) for entity in registry.collect() for row in spine.collect()}
    rows = [tuple(row) for row in grid.collect()]
    assert grid.columns == [*registry.columns, *spine.columns]
    assert len(rows) == 4 * 71 and set(rows) == expected


def test_grid_that_starts_within_an_hour(spark):
    registry = spark.createDataFrame([("A", "M0", "UTC")], REGISTRY)
    hours = HourRange.between("2024-01-01 00:30", "2024-01-01 02:30")
    grid = entity_hour_grid(registry, hours, ["site", "machine"])
    rows = grid.select("start_time", "id_hours", "date_hour", "end_time").collect()
    assert sorted(rows) == sorted(hour_spine(spark, hours).collect())
    assert min(row.start_time for row in rows) == utc(2024, 1, 1, 0, 30)


def test_grid_is_spread_over_tasks_from_one_partition(spark):
    registry = spark.createDataFrame([("A", f"M{i}", "UTC") for i in range(50)], REGISTRY).coalesce(1)
    hours = HourRange.between("2024-01-01", "2024-12-31")
    grid = entity_hour_grid(registry, hours, ["site", "machine"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = grid.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)


def test_registry_keeps_matched_rows_only(spark):
    sites = spark.createDataFrame([("A", "UTC"), ("B", "UTC")], "site string, timezone string")
    machines = spark.createDataFrame(
        [("A", "M1"), ("A", "M2"), ("C", "M1"), (None, "M3")], "site string, machine string"
    )
    registry = entity_registry(sites, machines, ["site"])
    assert sorted(registry.collect()) == [("A", "UTC", "M1"), ("A", "UTC", "M2")]


def test_duplicate_keys(spark):
    registry = spark.createDataFrame([("A", "M1"), ("A", "M1"), ("A", "M2")], "site string, machine string")
    assert duplicate_keys(registry, ["site", "machine"]).collect() == [("A", "M1", 2)]


@pytest.mark.parametrize("zone, ok", [("UTC", True), ("Etc/UTC", True), ("America/Toronto", False)])
def test_session_zone_must_be_utc(spark, zone, ok):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        if ok:
            require_utc(spark)
        else:
            with pytest.raises(ValueError):
                require_utc(spark)
            with pytest.raises(ValueError):
                hour_spine(spark, HourRange.between("2024-01-01", "2024-01-01") )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_year_long_range_matches_calendar():
    hours = HourRange.between("2024-01-01", "2024-12-31 23:00")
    assert hours.count == 366 * 24
    assert hours.upper - hours.lower == timedelta(days=366).total_seconds()


def test_a_spine_of_all_years_is_spread(spark):
    log = spark.sql("SELECT explode(array(timestamp '0001-01-01 05:30:00', timestamp '9999-12-31 22:10:00')) AS ts")
    spine = hour_spine_over(log, "ts").select("id_hours")
    parts = spine.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    assert len(parts) > 1 and sum(p.n for p in parts) == (datetime(9999, 12, 31, 22) - datetime(1, 1, 1, 5)) // timedelta(hours=1) + 1
    assert max(p.n for p in parts) < 0.5 * sum(p.n for p in parts)
