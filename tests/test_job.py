"""The complete job on small CSV files, against plain Python; readers and sinks."""

import random
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import HourRange
from hourgrid.plans import (
    MachineLogs,
    machine_coverage,
    machine_event_rejects,
    machine_rejects,
    machine_report,
    machine_rollup,
)
from hourgrid.plans.machines import REPORT_COLUMNS, ROLLUP_SCHEMA
from hourgrid.sources import (
    publish,
    read_csv,
    read_daily,
    read_parquet,
    schemas,
    with_epochs,
    within_days,
    write_daily,
    write_rollup,
)

T0 = 1668988800  # 2022-11-21 00:00 UTC
HOURS = HourRange.between("2022-11-20 12:00", "2022-11-24 06:00")
MACHINES = [("London", "M1"), ("London", "M2"), ("Toronto", "M1"), ("Toronto", "M2")]
ZONES = {"London": "Europe/London", "Toronto": "America/Toronto"}
STATES = ["sorting", "blocked", "scheduled_downtime", "unscheduled_downtime", "idle"]


def make_rows(seed=11):
    pick = random.Random(seed)
    states, attempts, unloads, items = [], [], [], []
    for i in range(120):
        start = T0 + 6000 * (i % 60)
        states.append((i, start, start + pick.choice([600, 6000, 20000]), pick.choice(STATES),
                       *pick.choice(MACHINES), start + 60))
        attempts.append((f"a{i}", T0 + 1000 * i, T0 + 1000 * i + 10,
                         pick.choice(["complete", "partial"]), pick.choice(["null", "System Failure"]),
                         *pick.choice(MACHINES), T0))
        unloads.append((i, f"o{i}", T0 + 1000 * i, *pick.choice(MACHINES), T0))
        items.append((pick.randrange(150), f"i{i}", *pick.choice(MACHINES), T0))
    return states, attempts, unloads, items


ROWS = make_rows()


def write_csv(path, schema, rows, blank_first_line=False):
    lines = [""] if blank_first_line else []
    lines += [",".join(schema.names), *[",".join(map(str, row)) for row in rows]]
    path.write_text("\n".join(lines))
    return str(path)


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("logs")
    states, attempts, unloads, items = ROWS
    bad = [(900, "abc", T0, "sorting", "London", "M1", T0), (901, T0 + 9, T0, "sorting", "London", "M1", T0),
           (902, T0, "", "blocked", "London", "M1", T0)]
    return MachineLogs.from_csv(
        spark,
        sites=write_csv(folder / "a.csv", schemas.SITES, [*ZONES.items(), ("Paris", "Europe/Paris")]),
        machines=write_csv(folder / "b.csv", schemas.MACHINES, [*MACHINES, ("Rome", "M1")]),
        states=write_csv(folder / "c.csv", schemas.STATES, states + bad),
        attempts=write_csv(folder / "d.csv", schemas.ATTEMPTS, attempts),
        unloads=write_csv(folder / "e.csv", schemas.UNLOADS, unloads),
        unload_items=write_csv(folder / "f.csv", schemas.UNLOAD_ITEMS, items, blank_first_line=True),
    )


@pytest.fixture(scope="module")
def rollup(logs):
    return machine_rollup(logs, HOURS).cache()


def expected_cells():
    """(site, machine, hour) -> six metrics, second by second and row by row."""
    states, attempts, unloads, items = ROWS
    hour = lambda s: s - s % 3600
    run, down, stuck, tried, done, units = (Counter() for _ in range(6))
    target = {"sorting": run, "blocked": stuck, "scheduled_downtime": down, "unscheduled_downtime": down}
    for _, start, end, state, site, machine, _ in states:
        if state in target:
            for second in range(start, end):
                target[state][site, machine, hour(second)] += 1
    for _, start, _, outcome, _, site, machine, _ in attempts:
        tried[site, machine, hour(start)] += 1
        if outcome == "complete":
            done[site, machine, hour(start)] += 1
    owned = Counter((site, machine, unload) for unload, _, site, machine, _ in items)
    for unload, _, time, site, machine, _ in unloads:
        units[site, machine, hour(time)] += owned[site, machine, unload]
    tables = (run, down, stuck, tried, done, units)
    keys = {key for table in tables for key in table if HOURS.lower <= key[2] < HOURS.upper}
    return {key: tuple(table[key] if key in table else None for table in tables) for key in keys}


def test_contract(rollup):
    declared = [field.split() for field in ROLLUP_SCHEMA.split(", ")]
    assert [list(pair) for pair in rollup.dtypes] == declared


def test_every_cell(rollup):
    rows = rollup.collect()
    assert len(rows) == len(MACHINES) * HOURS.count
    found = {}
    for row in rows:
        metrics = tuple(row)[7:13]
        start = int(row.start_time.replace(tzinfo=timezone.utc).timestamp())
        assert row.date_hour == row.start_time.strftime("%Y-%m-%d %H")
        assert row.id_hours == (start - HOURS.first) // 3600
        assert (row.end_time - row.start_time).total_seconds() == 3599
        assert row.timezone == ZONES[row.orb_site]
        if any(metric is not None for metric in metrics):
            found[row.orb_site, row.machine_name, start] = metrics
    assert found == expected_cells()


def test_report(rollup):
    report = machine_report(
        rollup, since="2022-11-21 19:00", where=F.col("orb_site") == "Toronto", limit=70
    )
    rows = report.collect()
    assert report.columns == REPORT_COLUMNS
    assert len(rows) == 70
    assert rows[0].start_time == datetime(2022, 11, 21, 19)
    assert [row.machine_name for row in rows] == ["M1"] * 60 + ["M2"] * 10
    assert all(row.units_unloaded is not None for row in rows)
    by_label = machine_report(
        rollup, where="date_hour >= '2022-11-21 19' and orb_site = 'Toronto'", limit=70
    )
    assert by_label.collect() == rows


def test_report_over_part_of_the_range(logs, rollup):
    since = "2022-11-21 19:00"
    part = machine_rollup(logs.at_site("Toronto"), HOURS.since(since))
    wanted = machine_report(rollup, since=since, where=F.col("orb_site") == "Toronto")
    assert machine_report(part).collect() == wanted.collect()


def test_rejects(logs):
    rows = machine_rejects(logs).select("id", "reject_reason").collect()
    assert sorted(rows) == [("900", "no start"), ("901", "reversed"), ("902", "no end")]


def test_coverage(logs, rollup):
    rows = {row.metric: row for row in machine_coverage(logs, HOURS).collect()}
    for metric, row in rows.items():
        inside = rollup.agg(F.sum(metric)).first()[0]
        assert row.in_rollup == inside
        assert row.total == row.in_rollup + row.unregistered + row.outside_hours + row.no_time + row.no_parent
    assert rows["total_attempts"].total == 120


def test_header_must_match(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("meta_machine_name,meta_orb_site\nM1,London")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(path), schemas.MACHINES).collect()


def test_csv_text_stays_text(spark, tmp_path):
    path = write_csv(tmp_path / "x.csv", schemas.ATTEMPTS, [("007", "16.5", "bad", "", "null", "A", "M", "")])
    row = with_epochs(read_csv(spark, path, schemas.ATTEMPTS), ["start_time", "end_time"]).first()
    assert (row.id, row.outcome, row.terminating_error) == ("007", None, "null")
    assert row.start_time == datetime(1970, 1, 1, 0, 0, 16, 500000) and row.end_time is None


def test_write_keeps_nulls(spark, rollup, tmp_path):
    for format in ("parquet", "orc", "json"):
        path = str(tmp_path / format)
        write_rollup(rollup, format, path=path)
        write_rollup(rollup, format, path=path)
        back = spark.read.schema(ROLLUP_SCHEMA).format(format).load(path)
        assert back.exceptAll(rollup).count() == 0 and back.count() == rollup.count()


def test_jdbc_options_reach_the_driver_manager(rollup):
    with pytest.raises(Exception, match="No suitable driver"):
        write_rollup(rollup, "jdbc", url="jdbc:none://nowhere/db", dbtable="t", user="u", password="p")


def test_write_and_read_days(spark, rollup, tmp_path):
    path = str(tmp_path / "days")
    write_daily(rollup, path)
    assert sorted(p.name for p in (tmp_path / "days").glob("day=*")) == [
        f"day=2022-11-{day}" for day in range(20, 25)
    ]
    back = read_daily(spark, path, ROLLUP_SCHEMA)
    assert back.columns == rollup.columns
    assert back.exceptAll(rollup).count() == 0 and back.count() == rollup.count()
    part = read_daily(spark, path, ROLLUP_SCHEMA, hours=HourRange.between("2022-11-21 20:00", "2022-11-22 03:00"))
    assert part.count() == len(MACHINES) * 8
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_published_rollup_is_read_not_computed(rollup, tmp_path):
    table = publish(rollup, str(tmp_path / "days"))
    assert table.columns == rollup.columns
    assert machine_report(table).collect() == machine_report(rollup).collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "InMemory" not in plan.replace("InMemoryFileIndex", "")


def test_one_day_can_be_replaced(spark, rollup, tmp_path):
    path = str(tmp_path / "days")
    write_daily(rollup, path)
    day = rollup.filter("to_date(start_time) = '2022-11-22'").withColumn("blocked_seconds", F.lit(-1).cast("bigint"))
    write_daily(day, path, partitionOverwriteMode="dynamic")
    back = read_daily(spark, path, ROLLUP_SCHEMA)
    assert back.count() == rollup.count()
    assert back.filter("blocked_seconds = -1").count() == day.count() == len(MACHINES) * 24


def test_logs_by_day_are_pruned(spark, tmp_path):
    log = spark.range(0, 10 * 24).selectExpr(
        "id", "timestamp_seconds(1668988800 + id * 3600) AS ts",
        "timestamp_seconds(1668988800 + id * 3600 + 90000) AS ts_end",
    )
    log.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(str(tmp_path / "log"))
    stored = read_parquet(spark, str(tmp_path / "log"), "id bigint, ts timestamp, ts_end timestamp, day date")
    hours = HourRange.between("2022-11-23 22:00", "2022-11-24 01:00")
    points = within_days(stored, "day", hours)
    assert {str(row.day) for row in points.select("day").distinct().collect()} == {"2022-11-23", "2022-11-24"}
    assert points.filter(hours.holds(F.col("ts"))).count() == 4
    spans = within_days(stored, "day", hours, spans=True)
    overlapping = stored.filter((F.col("ts") < hours.upper_ts) & (F.col("ts_end") > hours.lower_ts))
    assert spans.intersect(overlapping).count() == overlapping.count()
    assert spans.agg(F.max("day").cast("string")).first()[0] == "2022-11-24"


def test_publish_returns_what_it_wrote(rollup, logs, tmp_path):
    path = str(tmp_path / "days")
    day = HourRange.between("2022-11-22", "2022-11-22 23:00")
    write_daily(rollup.filter("to_date(start_time) <> '2022-11-22'"), path)
    table = publish(machine_rollup(logs, day), path, hours=day, partitionOverwriteMode="dynamic")
    assert table.count() == len(MACHINES) * 24
    with pytest.raises(ValueError):
        publish(rollup, path, hours=HOURS, mode="append")
    with pytest.raises(ValueError):
        publish(rollup, path, partitionOverwriteMode="dynamic")


def test_malformed_times_are_rejected_and_counted(spark, logs, tmp_path):
    attempts = write_csv(tmp_path / "a.csv", schemas.ATTEMPTS, [
        ("a1", "oops", 1, "complete", "null", "London", "M1", T0), ("a2", T0, T0, "complete", "null", "London", "M1", T0),
    ])
    unloads = write_csv(tmp_path / "u.csv", schemas.UNLOADS, [("1", "o", "", "London", "M1", T0), ("2", "o", T0, "London", "M1", T0)])
    items = write_csv(tmp_path / "i.csv", schemas.UNLOAD_ITEMS, [
        (unload, f"i{k}", "London", "M1", T0) for k, unload in enumerate("112299")
    ])
    some = MachineLogs(
        logs.sites, logs.machines, logs.states,
        with_epochs(read_csv(spark, attempts, schemas.ATTEMPTS), ["start_time", "end_time"]),
        with_epochs(read_csv(spark, unloads, schemas.UNLOADS), ["event_time"]), read_csv(spark, items, schemas.UNLOAD_ITEMS),
    )
    rows = machine_event_rejects(some).select("log", "id", "time_text", "reject_reason").collect()
    assert sorted(map(tuple, rows)) == [("attempts", "a1", "oops", "no time"), ("unloads", "1", None, "no time")]
    parts = {r.metric: tuple(r)[1:] for r in machine_coverage(some, HOURS).collect()}
    assert parts["total_attempts"] == (2, 1, 0, 0, 1, 0)
    assert parts["units_unloaded"] == (6, 2, 0, 0, 2, 2)


def test_one_site_and_stored_days(spark, logs, rollup, tmp_path):
    part = machine_rollup(logs, HOURS, site="Toronto")
    assert part.exceptAll(rollup.filter("orb_site = 'Toronto'")).count() == 0 and part.count() == 2 * HOURS.count
    plan = part._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 6 and all("EqualTo(meta_orb_site,Toronto)" in s or "EqualTo(orb_site,Toronto)" in s for s in scans)
    paths = {}
    for name in ("sites", "machines", "states", "attempts", "unloads", "unload_items"):
        rows, paths[name] = getattr(logs, name), str(tmp_path / name)
        ts = {"states": "start_time", "attempts": "start_time", "unloads": "event_time"}.get(name)
        if ts:
            rows.withColumn("day", F.to_date(ts)).write.partitionBy("day").parquet(paths[name])
        else:
            rows.write.parquet(paths[name])
    day = HourRange.between("2022-11-22", "2022-11-22 23:00")
    table = machine_rollup(MachineLogs.from_parquet(spark, **paths, hours=day), day)
    assert "PartitionFilters: [isnotnull(day" in table._jdf.queryExecution().executedPlan().toString()
    assert table.drop("id_hours").exceptAll(rollup.drop("id_hours")).count() == 0
    assert table.count() == len(MACHINES) * 24


def test_totals_of_a_known_shape(spark):
    """Machines that sort 100 s, are blocked 50 s, try twice and unload 3 units in each of 20
    hours: totals and non-NULL cells are known beforehand."""
    names = [(f"S{m % 5}", f"M{m}") for m in range(25)]
    cells = [(s, m, T0 + 3600 * h) for s, m in names for h in range(20)]
    frame = spark.createDataFrame
    at = lambda t: datetime.fromtimestamp(t, timezone.utc).replace(tzinfo=None)
    logs = MachineLogs(
        frame([(f"S{s}", "UTC") for s in range(5)], "meta_orb_site string, timezone string"),
        frame(names, "meta_orb_site string, meta_machine_name string"),
        frame([(s, m, at(t + 10), at(t + 110), "sorting") for s, m, t in cells]
              + [(s, m, at(t + 3575), at(t + 3625), "blocked") for s, m, t in cells],
              "meta_orb_site string, meta_machine_name string, start_time timestamp, end_time timestamp, state string"),
        frame([(s, m, f"{m}{t}{k}", at(t), ["complete", "partial"][k]) for s, m, t in cells for k in (0, 1)],
              "meta_orb_site string, meta_machine_name string, id string, start_time timestamp, outcome string"),
        frame([(s, m, f"{t}", at(t)) for s, m, t in cells],
              "meta_orb_site string, meta_machine_name string, unload_id string, event_time timestamp"),
        frame([(s, m, f"{t}", f"{k}") for s, m, t in cells for k in range(3)],
              "meta_orb_site string, meta_machine_name string, unload_id string, item_id string"),
    )
    hours = HourRange.between("2022-11-21", "2022-11-22 23:00")
    metrics = ["operating_seconds", "downtime_seconds", "blocked_seconds", "total_attempts", "complete_attempts", "units_unloaded"]
    row = machine_rollup(logs, hours).agg(
        F.count(F.lit(1)).alias("rows"), *[F.struct(F.sum(m), F.count(m)).alias(m) for m in metrics]
    ).first()
    assert row.rows == 25 * 48
    assert [tuple(row[m]) for m in metrics] == [
        (50_000, 500), (None, 0), (25_000, 525), (1_000, 500), (500, 500), (1_500, 500),
    ]
