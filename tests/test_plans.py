"""The shape of the physical plans: what is scanned, pushed down and shuffled."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from hourgrid.operators import HourRange, event_leg, split_intervals
from hourgrid.sources import read_parquet, write_daily

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, table):
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{table}.parquet" in line]


@pytest.fixture
def big_tables(spark):
    """Plans as they are for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(set(contract.hourly_queries()) - {"write_rollup", "write_daily", "daily_intervals"}))
def test_no_cross_joins_no_python_no_forced_broadcast(big_tables, name):
    plan = plan_of(contract.hourly_queries()[name](big_tables, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "Python", "ExistingRDD"):
        assert node not in plan, node


def test_rollup_reads_each_log_once(big_tables):
    plan = plan_of(contract.rollup(big_tables, SF_DIR))
    # The events table stands for two logs, the intervals and the attempts.
    assert {t: len(scans(plan, t)) for t in ("events", "orders", "lineitem", "nation", "region")} == {
        "events": 2, "orders": 1, "lineitem": 1, "nation": 1, "region": 1,
    }


def test_rollup_shuffles(big_tables):
    """Per leg one exchange, three more for parents and children, two for the registry,
    two to spread it and then the grid, and one to bring it to the legs."""
    plan = plan_of(contract.rollup(big_tables, SF_DIR))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3 + 3 + 2 + 2 + 1
    assert len(re.findall(r"SortMergeJoin", plan)) == 3 + 1 + 1


def test_every_leg_is_summed_before_its_shuffle(big_tables):
    plan = plan_of(contract.rollup(big_tables, SF_DIR))
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    legs = [i for i, line in enumerate(lines) if line.startswith("Exchange") and "bucket" in line]
    below = [lines[i + 1] for i in legs]
    assert sum("partial_" in line for line in below) == 4  # three legs and the parents
    assert sum("Project" in line for line in below) == 1  # the grid


def test_parents_and_children_are_counted_before_they_meet(big_tables):
    plan = plan_of(contract.child_counts(big_tables, SF_DIR))
    lines = [line.strip(" :+-*()0123456789") for line in plan.splitlines()]
    below = [lines[i + 1] for i, line in enumerate(lines) if line.startswith("Exchange")]
    assert ["partial_" in line for line in below].count(True) == 3  # parents, children, result
    (again,) = [line for line in below if "partial_" not in line]  # counted parents, to the join
    assert again.startswith("HashAggregate") and "functions=[count(1)]" in again


def test_range_and_states_reach_the_scan(big_tables):
    plan = plan_of(contract.rollup(big_tables, SF_DIR))
    states, attempts = sorted(scans(plan, "events"), key=lambda line: "In(event_type" not in line)
    assert "In(event_type, [click,error,purchase,signup])" in states
    assert "LessThan(ts,2024-01-31 01:00:00.0)" in states
    assert "GreaterThanOrEqual(ts,2024-01-01 00:00:00.0), LessThan(ts,2024-01-31 01:00:00.0)" in attempts


def test_only_columns_in_use_are_read(big_tables):
    plan = plan_of(contract.event_counts(big_tables, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint>" in plan


def test_report_is_a_top_k_that_filters_its_inputs(big_tables):
    plan = plan_of(contract.report(big_tables, SF_DIR))
    assert "TakeOrderedAndProject(limit=500" in plan
    # The site reaches both event scans, the parents, and the registry's sites.
    assert len(re.findall(r"Filter .*= AMERICA\)", plan)) >= 4


def test_report_takes_its_rows_before_the_joins(big_tables):
    df = contract.report(big_tables, SF_DIR)
    optimized = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    limits = [i for i, line in enumerate(optimized) if "GlobalLimit 500" in line]
    joins = [i for i, line in enumerate(optimized) if "Join LeftOuter" in line and "bucket" in line]
    assert len(joins) == 3 and limits[0] < joins[0] and limits[-1] > joins[-1]


def test_split_is_one_stage_of_generated_code(big_tables):
    df = contract.splits(big_tables, SF_DIR)
    assert "Exchange" not in plan_of(df)
    df.collect()
    final = plan_of(df)
    assert re.search(r"\*\(1\) Generate explode", final)


def test_days_are_rebalanced_before_the_write(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "timestamp_seconds(id * 3600) AS start_time").repartition(8)
    write_daily(rows, str(tmp_path / "days"))
    files = list((tmp_path / "days").rglob("*.parquet"))
    assert len(files) == len(list((tmp_path / "days").glob("day=*"))) == 42


def test_zoneless_timestamps_give_the_same_result(spark):
    """Columns inferred as timestamp_ntz, against the declared schema."""
    hours = HourRange.between("2024-01-05", "2024-01-06")
    declared = read_parquet(spark, f"{SF_DIR}/events.parquet", "event_id bigint, ts timestamp")
    inferred = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_id", "ts")
    assert dict(inferred.dtypes)["ts"] == "timestamp_ntz"

    def results(log):
        spans = log.withColumn("later", F.col("ts") + F.expr("interval 90 minutes"))
        pieces = split_intervals(spans, start="ts", end="later", hours=hours).drop("ts", "later")
        return pieces, event_leg(log, {"n": None}, keys=["event_id"], ts="ts", id="event_id", hours=hours)

    for a, b in zip(results(declared), results(inferred), strict=True):
        assert a.count() > 0
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
