import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from hourgrid.operators import (
    HourRange,
    child_count_by_hour,
    coverage,
    duplicate_keys,
    event_leg,
    events_by_hour,
    hourly_rollup,
    report_view,
    state_leg,
    state_seconds_by_hour,
    with_local_time,
)

KEYS = ["site", "machine"]
HOURS = HourRange.between("2022-11-06 00:00", "2022-11-06 09:00")
CLASSES = {"run": ["on"], "down": ["off"]}


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(
        [("A", "M", "America/Toronto"), ("A", "N", "America/Toronto"), ("B", "M", "Asia/Kolkata")],
        "site string, machine string, timezone string",
    )


@pytest.fixture(scope="module")
def log(spark):
    return spark.sql("""
        SELECT site, machine, id, state, timestamp(a) AS ts, timestamp(b) AS ts_end FROM VALUES
          ('A', 'M', '1', 'on', '2022-11-05 23:30:00', '2022-11-06 01:10:00'),
          ('A', 'M', '2', 'off', '2022-11-06 09:00:00', '2022-11-06 11:00:00'),
          ('B', 'M', '3', 'on', '2022-11-06 02:00:00', '2022-11-06 02:00:30'),
          ('B', 'X', '4', 'on', '2022-11-06 02:00:00', '2022-11-06 02:00:30'),
          (NULL, 'M', '5', 'on', '2022-11-06 02:00:00', '2022-11-06 02:00:30'),
          ('A', 'N', '6', 'on', '2022-11-07 02:00:00', '2022-11-07 02:00:30'),
          ('A', 'N', '7', 'idle', '2022-11-06 03:00:00', '2022-11-06 03:00:30')
        AS t(site, machine, id, state, a, b)""")


def legs(log, keep_outside=False):
    bounds = {"keys": KEYS, "hours": HOURS, "keep_outside": keep_outside}
    return [
        state_leg(log, CLASSES, start="ts", end="ts_end", state="state", **bounds),
        event_leg(log, {"n": None, "n_on": F.col("state") == "on"}, ts="ts", id="id", **bounds),
    ]


@pytest.fixture(scope="module")
def rollup(registry, log):
    return hourly_rollup(registry, HOURS, legs(log), keys=KEYS).cache()


def cells(rollup, *names):
    rows = rollup.select("site", "machine", "id_hours", *names).collect()
    return {tuple(row)[:3]: tuple(row)[3:] for row in rows if any(v is not None for v in tuple(row)[3:])}


def test_dense_and_unique(rollup):
    assert rollup.count() == 3 * 10
    assert duplicate_keys(rollup, [*KEYS, "start_time"]).count() == 0
    assert rollup.columns == [
        *KEYS, "date_hour", "start_time", "id_hours", "end_time", "timezone",
        "run", "down", "n", "n_on", "local_start_time", "local_end_time",
    ]


def test_cells(rollup):
    assert cells(rollup, "run", "down", "n", "n_on") == {
        ("A", "M", 0): (3600, None, None, None),
        ("A", "M", 1): (600, None, None, None),
        ("A", "M", 9): (None, 3600, 1, None),
        ("B", "M", 2): (30, None, 1, 1),
        ("A", "N", 3): (None, None, 1, None),
    }


def test_coverage_accounts_for_everything(registry, log):
    rows = {row.metric: tuple(row)[1:] for row in coverage(registry, legs(log, True), keys=KEYS).collect()}
    assert rows == {
        # total, in the rollup, unregistered, outside the hours, without time, without parent
        "run": (6000 + 30 + 30 + 30 + 30, 4200 + 30, 60, 1800 + 30, 0, 0),
        "down": (7200, 3600, 0, 3600, 0, 0),
        "n": (7, 3, 2, 2, 0, 0),
        "n_on": (5, 1, 2, 2, 0, 0),
    }


def test_coverage_of_nothing(registry, log):
    rows = coverage(registry, legs(log.filter("false"), True), keys=KEYS).collect()
    assert sorted(map(tuple, rows)) == [(name, 0, 0, 0, 0, 0, 0) for name in ("down", "n", "n_on", "run")]


def test_local_time_over_a_clock_change(rollup):
    rows = rollup.filter("site = 'A' and machine = 'M'").orderBy("id_hours").collect()
    # Toronto leaves daylight saving time at 06:00 UTC, so 01:00 comes twice.
    assert [row.local_start_time.strftime("%d %H") for row in rows[3:8]] == [
        "05 23", "06 00", "06 01", "06 01", "06 02",
    ]
    assert rows[0].local_end_time.strftime("%H:%M:%S") == "20:59:59"


def test_local_time_reads_the_zone_of_each_row(rollup):
    row = rollup.filter("site = 'B' and id_hours = 0").first()
    assert row.local_start_time.strftime("%H:%M") == "05:30"


def test_local_time_without_a_zone(spark):
    df = spark.sql("SELECT timestamp '2024-01-01' AS ts, cast(NULL AS string) AS zone")
    assert with_local_time(df, {"local": "ts"}, "zone").first().local is None


def test_a_range_within_the_hour_joins_on_the_hour(registry, log):
    hours = HourRange.between("2022-11-06 00:30", "2022-11-06 02:30")
    leg = state_leg(log, CLASSES, start="ts", end="ts_end", state="state", keys=KEYS, hours=hours)
    rollup = hourly_rollup(registry, hours, [leg], keys=KEYS)
    assert cells(rollup, "run") == {("A", "M", 0): (3600,), ("A", "M", 1): (600,), ("B", "M", 2): (30,)}
    assert {row.start_time.minute for row in rollup.collect()} == {30}


def test_a_repeated_registry_row_repeats_its_hours(registry, log):
    twice = registry.union(registry.filter("site = 'B'"))
    assert hourly_rollup(twice, HOURS, legs(log), keys=KEYS).count() == 4 * 10


def test_report_fills_numbers_only(rollup):
    view = report_view(
        rollup, where=F.col("site") == "A", order_by=["site", "machine", "start_time"],
        columns=["machine", "start_time", "run", "n", "timezone"], limit=12,
    )
    rows = view.collect()
    assert [(row.machine, row.start_time.hour) for row in rows] == [
        ("M", h) for h in range(10)
    ] + [("N", 0), ("N", 1)]
    assert [(row.run, row.n) for row in rows[:3]] == [(3600, 0), (600, 0), (0, 0)]
    assert report_view(rollup, order_by=["start_time"], columns=["run"], limit=None).count() == 30


def test_one_pass_equals_one_table_per_metric(spark):
    """The merged rollup against six separate tables joined one after the other."""
    sf_dir = "/root/testdata/sf0.001"
    events = contract._intervals(spark, sf_dir)
    unloads = contract._unloads(spark, sf_dir)
    keys = contract.MACHINE
    tables = [
        state_seconds_by_hour(
            events, {metric: names}, keys=keys, start="ts", end="ts_end", state="event_type"
        )
        for metric, names in contract.CLASSES.items()
    ]
    tables += [
        events_by_hour(events, keys=keys, ts="ts", id="event_id", name="total_attempts"),
        events_by_hour(
            events, keys=keys, ts="ts", id="event_id", where=contract._complete(),
            name="complete_attempts",
        ),
        child_count_by_hour(
            unloads, contract._table(spark, sf_dir, "lineitem"), on=["l_orderkey"], keys=keys,
            ts="ts", item="l_linenumber", name="units_unloaded",
        ),
    ]
    merged = contract._dense(spark, sf_dir)
    metrics = [table.columns[-1] for table in tables]
    chained = merged.drop(*metrics)
    for table in tables:
        table = table.withColumnRenamed("bucket", "start_time")
        chained = chained.join(table, [*keys, "start_time"], "left")
    columns = merged.columns
    assert chained.select(columns).exceptAll(merged).count() == 0
    assert merged.exceptAll(chained.select(columns)).count() == 0


def test_known_totals(spark):
    """Sums and non-NULL cells found in two engines before this code was written."""
    rollup = contract._rollup(spark, "/root/testdata/sf0.01")
    expected = {
        "operating_seconds": (14_067_168, 5_096), "downtime_seconds": (29_279_741, 8_982),
        "blocked_seconds": (14_526_367, 5_171), "total_attempts": (10_000, 7_653),
        "complete_attempts": (1_981, 1_881),
    }
    row = rollup.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.struct(F.sum(name), F.count(name)).alias(name) for name in expected],
    ).first()
    assert row.rows == 18_025
    assert {name: tuple(row[name]) for name in expected} == expected
