"""

The tables hold no machine logs, so each query maps some columns to the roles the
operators need: regions are sites, nations their machines (an event belongs to machine
``user_id % 25``), events are both the interval log and the point events, orders with
their lines the parents and children. Timestamps are compared as text or epochs.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourgrid.functions import epoch_to_ts  # noqa: E402
from hourgrid.operators import (  # noqa: E402
    BUCKET,
    HourRange,
    child_count_by_hour,
    child_leg,
    coverage,
    duplicate_keys,
    entity_hour_grid,
    entity_registry,
    event_leg,
    event_rejects,
    events_by_hour,
    hour_spine,
    hour_spine_over,
    hourly_rollup,
    interval_rejects,
    report_view,
    split_intervals,
    state_leg,
    state_seconds_by_hour,
    with_local_time,
)
from hourgrid.plans.machines import REPORT_COLUMNS, REPORT_ORDER, ROLLUP_SCHEMA  # noqa: E402
from hourgrid.sources import (  # noqa: E402
    publish,
    read_intervals,
    read_parquet,
    write_intervals,
    write_rollup,
)

try:  # the operators for training data, their pipeline and what these need may be absent
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL, run as pipeline  # noqa: E402
    from hourgrid.llm.queries import ORACLES as MORE_SQL, QUERIES as MORE_QUERIES  # noqa: E402
except ModuleNotFoundError as missing:
    print(f"no queries for training data: there is no module {missing.name}", file=sys.stderr)
    PIPELINE_SQL, MORE_SQL, MORE_QUERIES = None, {}, {}
else:
    MORE_QUERIES = MORE_QUERIES | {"pipeline": pipeline}
    MORE_SQL = MORE_SQL | ({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})

HOURS = HourRange.between("2024-01-01", "2024-01-31")
REPORT_SITE = "AMERICA"
REPORT_SINCE = "2024-01-05 19:00:00"
KEYS = ["orb_site", "machine_name"]
MACHINE = ["machine"]
ZONES = {
    "AFRICA": "Africa/Nairobi",
    "AMERICA": "America/Toronto",
    "ASIA": "Asia/Kolkata",
    "EUROPE": "Europe/London",
}
OTHER_ZONE = "Asia/Dubai"
CLASSES = {
    "operating_seconds": ["purchase"],
    "downtime_seconds": ["error", "signup"],
    "blocked_seconds": ["click"],
}
COMPLETE = "purchase"
# Ranges written one after the other into one folder.
FIRST_HALF = HourRange.between("2024-01-01", "2024-01-15 23:00")
SECOND_HALF = HourRange.between("2024-01-16", "2024-01-31")
# Two days, whose intervals may have begun weeks before.
TWO_DAYS = HourRange.between("2024-01-20", "2024-01-21 23:00")

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp",
    "lineitem": "l_orderkey bigint, l_linenumber int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def _as_text(df: DataFrame) -> DataFrame:
    form = "date_format({0}, 'yyyy-MM-dd HH:mm:ss') AS {0}"
    return df.selectExpr(*[form.format(c) if t == "timestamp" else c for c, t in df.dtypes])


def _complete() -> Column:
    return F.col("event_type") == COMPLETE


def _zone(region: str) -> Column:
    zone = F.lit(OTHER_ZONE)
    for name, value in ZONES.items():
        zone = F.when(F.col(region) == name, value).otherwise(zone)
    return zone


# Inputs in the roles of the operators


def _registry(spark: SparkSession, sf_dir: str, site: str | None = None) -> DataFrame:
    """Machine = nation, site = region; logs know machines by number, the registry their names."""
    sites = _table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("orb_site"),
        _zone("r_name").alias("timezone"),
    )
    machines = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("machine"), F.col("n_name").alias("machine_name"), "n_regionkey"
    )
    if site is not None:
        sites = sites.filter(F.col("orb_site") == site)
    return entity_registry(sites, machines, ["n_regionkey"]).select(*MACHINE, *KEYS, "timezone")


def _supplier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine = supplier, site = nation: a registry that grows with the data."""
    sites = (
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("site_key"), F.col("n_name").alias("orb_site"),
            _zone("r_name").alias("timezone"),
        )
    )
    machines = _table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("site_key"), F.col("s_name").alias("machine_name")
    )
    return entity_registry(sites, machines, ["site_key"]).select(*KEYS, "timezone")


def _intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intervals of up to four hours."""
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id % 25 AS machine", "event_type", "ts",
        "timestamp_seconds(unix_seconds(ts) + (event_id * 997) % 14400) AS ts_end",
    )


def _unloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as parents spread over a little more than the hours of the spine."""
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS l_orderkey", "o_custkey % 25 AS machine",
        f"timestamp_seconds({HOURS.lower} + (o_orderkey * 997) % 2700000) AS ts",
    )


def _some_without_time(log: DataFrame, id: str) -> DataFrame:
    """Every tenth row without a time."""
    return log.withColumn("ts", F.when(F.col(id) % 10 != 0, F.col("ts")))


def _legs(
    spark: SparkSession, sf_dir: str, hours: HourRange = HOURS, keep_outside: bool = False,
    site: str | None = None,
) -> list[DataFrame]:
    """With ``site``, logs of its machines only. With ``keep_outside``, every tenth event and order without a time, and every seventh
    order under a key that no line has."""
    intervals, unloads = _intervals(spark, sf_dir), _unloads(spark, sf_dir)
    points = intervals
    if keep_outside:
        points = _some_without_time(intervals, "event_id")
        unloads = _strayed(_some_without_time(unloads, "l_orderkey"))
    if site is not None:
        own = _registry(spark, sf_dir, site).select(*MACHINE)
        intervals, points, unloads = (
            log.join(own, MACHINE, "left_semi") for log in (intervals, points, unloads)
        )
    bounds = {"keys": MACHINE, "hours": hours, "keep_outside": keep_outside}
    return [
        state_leg(intervals, CLASSES, start="ts", end="ts_end", state="event_type", **bounds),
        event_leg(
            points, {"total_attempts": None, "complete_attempts": _complete()},
            ts="ts", id="event_id", **bounds,
        ),
        child_leg(
            unloads, _table(spark, sf_dir, "lineitem"),
            on=["l_orderkey"], ts="ts", item="l_linenumber", name="units_unloaded", **bounds,
        ),
    ]


def _strayed(orders: DataFrame) -> DataFrame:
    """Every seventh order under a negative key, which no line has."""
    return orders.withColumn(
        "l_orderkey", F.when(F.col("l_orderkey") % 7 == 0, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    )


def _rollup(
    spark: SparkSession, sf_dir: str, hours: HourRange = HOURS, site: str | None = None, **first
) -> DataFrame:
    return _dense(spark, sf_dir, hours, site, **first).select(*[c.split()[0] for c in ROLLUP_SCHEMA.split(", ")])


def _dense(
    spark: SparkSession, sf_dir: str, hours: HourRange = HOURS, site: str | None = None, **first
) -> DataFrame:
    legs = _legs(spark, sf_dir, hours, site=site)
    return hourly_rollup(_registry(spark, sf_dir, site), hours, legs, keys=MACHINE, **first)


def _scratch(spark: SparkSession) -> str:
    """A new folder for a result, in the one folder of this application, which goes when the
    session ends. It stands in ``spark.hourgrid.results.dir`` or, where that is not set, in
    the shared place the cluster names; in a local session that names none, in a temporary
    folder."""
    shared = spark.conf.get("spark.hourgrid.results.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.hourgrid.results.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    own = f"{shared.rstrip('/')}/hourgrid-{spark.sparkContext.applicationId}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{own}/{uuid.uuid4().hex}"


# Queries


def hour_spine_of_events(spark, sf_dir):
    return _as_text(hour_spine_over(_table(spark, sf_dir, "events"), "ts"))


def spine_of_range(spark, sf_dir):
    """Events per hour of a given range, its first and last hour included."""
    spine = hour_spine(spark, HOURS)
    events = events_by_hour(_intervals(spark, sf_dir), keys=[], ts="ts", id="event_id")
    joined = spine.join(events.withColumnRenamed(BUCKET, "start_time"), "start_time", "left")
    return _as_text(joined)


def registry(spark, sf_dir):
    return _supplier_registry(spark, sf_dir)


def repeated_keys(spark, sf_dir):
    return duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def grid(spark, sf_dir):
    rows = entity_hour_grid(_supplier_registry(spark, sf_dir), HOURS, KEYS)
    return rows.select(*KEYS, "date_hour")


def epochs(spark, sf_dir):
    text = F.when(F.col("event_id") % 10 == 0, "bad").otherwise(F.unix_seconds("ts").cast("string"))
    return _table(spark, sf_dir, "events").select(
        "event_id", F.unix_seconds(epoch_to_ts(text)).alias("epoch")
    )


def splits(spark, sf_dir):
    pieces = split_intervals(_intervals(spark, sf_dir), start="ts", end="ts_end")
    return _as_text(pieces.select("event_id", BUCKET, "seconds", "minutes"))


def rejects(spark, sf_dir):
    log = _intervals(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("ts"),
        F.when(F.col("event_id") % 7 != 0, F.col("ts_end") - F.expr("interval 30 minutes")).alias("ts_end"),
    )
    return interval_rejects(log, start="ts", end="ts_end").select("event_id", "reject_reason")


def point_rejects(spark, sf_dir):
    log = _some_without_time(_intervals(spark, sf_dir), "event_id")
    return event_rejects(log, ts="ts").select("event_id", "event_type", "reject_reason")


def state_seconds(spark, sf_dir):
    return _as_text(
        state_seconds_by_hour(
            _intervals(spark, sf_dir), CLASSES,
            keys=["machine"], start="ts", end="ts_end", state="event_type",
        )
    )


def event_counts(spark, sf_dir):
    log = _intervals(spark, sf_dir)
    return _as_text(events_by_hour(log, keys=["machine"], ts="ts", id="event_id"))


def event_counts_where(spark, sf_dir):
    log = _intervals(spark, sf_dir)
    return _as_text(
        events_by_hour(log, keys=["machine"], ts="ts", id="event_id", where=_complete())
    )


def child_counts(spark, sf_dir):
    parents = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 25).alias("machine"),
        "o_orderdate",
    )
    return _as_text(
        child_count_by_hour(
            parents, _table(spark, sf_dir, "lineitem"),
            on=["l_orderkey"], keys=["machine"], ts="o_orderdate", item="l_linenumber",
        )
    )


def child_counts_null_keys(spark, sf_dir):
    """A third of the parents without a key."""
    parents = _table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("l_orderkey"),
        (F.col("o_custkey") % 25).alias("machine"), "o_orderdate",
    )
    return _as_text(
        child_count_by_hour(
            parents, _table(spark, sf_dir, "lineitem"),
            on=["l_orderkey"], keys=["machine"], ts="o_orderdate", item="l_linenumber",
        )
    )


def orphans(spark, sf_dir):
    """Lines whose order is not there, by the coverage of their leg alone."""
    leg = child_leg(
        _strayed(_unloads(spark, sf_dir)), _table(spark, sf_dir, "lineitem"),
        on=["l_orderkey"], keys=MACHINE, ts="ts", item="l_linenumber", name="units_unloaded",
        hours=HOURS, keep_outside=True,
    )
    return coverage(_registry(spark, sf_dir), [leg], keys=MACHINE)


def rollup(spark, sf_dir):
    return _as_text(_rollup(spark, sf_dir))


def rollup_coverage(spark, sf_dir):
    """All legs against a registry that lacks a machine, so that every part occurs."""
    registry = _registry(spark, sf_dir).filter(F.col("machine_name") != "NATION_7")
    return coverage(registry, _legs(spark, sf_dir, keep_outside=True), keys=MACHINE)


def local_times(spark, sf_dir):
    events = _intervals(spark, sf_dir).join(_registry(spark, sf_dir), MACHINE)
    rows = with_local_time(events, {"local_ts": "ts", "local_end": "ts_end"}, "timezone")
    return _as_text(rows.select("event_id", "timezone", "ts", "local_ts", "local_end"))


def report(spark, sf_dir):
    first = {"order_by": REPORT_ORDER, "limit": 500}
    rows = report_view(
        _rollup(spark, sf_dir, HOURS.since(REPORT_SINCE), REPORT_SITE, **first),
        columns=REPORT_COLUMNS, **first,
    )
    return _as_text(rows)


def written_rollup(spark, sf_dir):
    path = _scratch(spark)
    write_rollup(_rollup(spark, sf_dir), "parquet", path=path)
    return _as_text(read_parquet(spark, path, ROLLUP_SCHEMA))


def written_days(spark, sf_dir):
    """Two ranges published into one folder; the second is what comes back."""
    path = _scratch(spark)
    for hours in (FIRST_HALF, SECOND_HALF):
        table = publish(_rollup(spark, sf_dir, hours), path, hours=hours, partitionOverwriteMode="dynamic")
    return _as_text(table)


def _long_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh interval goes on for up to twelve days, every thirtieth has no end."""
    end = "ts_end + make_interval(0, 0, 0, IF(event_id % 7 = 0, CAST(event_id % 13 AS INT), 0))"
    return _intervals(spark, sf_dir).selectExpr(
        "machine", "event_type", "ts", f"IF(event_id % 30 <> 1, {end}, NULL) AS ts_end"
    )


def days_of_intervals(spark, sf_dir):
    """Seconds by state within two days, from intervals stored by day and reach."""
    path = _scratch(spark)
    log = _long_intervals(spark, sf_dir)
    write_intervals(log, path, start="ts", end="ts_end")
    return _as_text(
        state_seconds_by_hour(
            read_intervals(spark, path, log.schema, hours=TWO_DAYS), CLASSES,
            keys=MACHINE, start="ts", end="ts_end", state="event_type", hours=TWO_DAYS,
        )
    )


def entry(spark: SparkSession) -> DataFrame:
    """Seconds by state, attempts and units per machine and hour, every hour filled."""
    return rollup(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return hourly_queries() | MORE_QUERIES


def hourly_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "hour_spine": hour_spine_of_events,
        "hour_spine_range": spine_of_range,
        "entity_registry": registry,
        "duplicate_keys": repeated_keys,
        "entity_hour_grid": grid,
        "epoch_to_ts": epochs,
        "split_intervals": splits,
        "interval_rejects": rejects,
        "event_rejects": point_rejects,
        "state_seconds_by_hour": state_seconds,
        "events_by_hour": event_counts,
        "events_by_hour_where": event_counts_where,
        "child_count_by_hour": child_counts,
        "child_count_null_keys": child_counts_null_keys,
        "child_orphans": orphans,
        "hourly_rollup": rollup,
        "coverage": rollup_coverage,
        "with_local_time": local_times,
        "report_view": report,
        "write_rollup": written_rollup,
        "write_daily": written_days,
        "daily_intervals": days_of_intervals,
    }


# The same results in SQL

_ZONE = "CASE r_name {} ELSE '{}' END".format(
    " ".join(f"WHEN '{name}' THEN '{zone}'" for name, zone in ZONES.items()), OTHER_ZONE
)
_TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_HOUR_TEXT = _TEXT.format("make_timestamp({} * 1000000)")
_LOCAL = "timezone({zone}, timezone('UTC', {ts}))"

_SITES = f"""
machines AS (
  SELECT CAST(n_nationkey AS BIGINT) AS machine, r_name AS orb_site, n_name AS machine_name,
         {_ZONE} AS timezone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_SUPPLIERS = f"""
suppliers AS (
  SELECT n_name AS orb_site, s_name AS machine_name, {_ZONE} AS timezone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

_PIECES = """
intervals AS (
  SELECT event_id, user_id % 25 AS machine, event_type, ts, s, s + (event_id * 997) % 14400 AS e
  FROM (SELECT *, epoch_us(ts) // 1000000 AS s FROM events)),
hours AS (
  SELECT *, unnest(generate_series(s - s % 3600, e - 1, 3600)) AS h
  FROM intervals WHERE e > s),
pieces AS (
  SELECT *, least(e, h + 3600) - greatest(s, h) AS seconds FROM hours)"""

_SECONDS = ", ".join(
    "CAST(sum(CASE WHEN event_type IN ({}) THEN seconds END) AS BIGINT) AS {}".format(
        ", ".join(f"'{state}'" for state in states), metric
    )
    for metric, states in CLASSES.items()
)
_STATES = ", ".join(f"'{state}'" for states in CLASSES.values() for state in states)

# One table per metric here, joined one by one: the plain form of the rollup.
_ROLLUP = f"""
WITH {_SITES}, {_PIECES},
spine AS (
  SELECT unnest(generate_series({HOURS.lower}, {HOURS.upper} - 1, 3600)) AS h),
states AS (
  SELECT machine, h, {_SECONDS} FROM pieces WHERE event_type IN ({_STATES}) GROUP BY machine, h),
attempts AS (
  SELECT machine, s - s % 3600 AS h, count(event_id) AS total_attempts
  FROM intervals GROUP BY ALL),
complete AS (
  SELECT machine, s - s % 3600 AS h, count(event_id) AS complete_attempts
  FROM intervals WHERE event_type = 'purchase' GROUP BY ALL),
unloads AS (
  SELECT o_orderkey, o_custkey % 25 AS machine,
         {HOURS.lower} + (o_orderkey * 997) % 2700000 AS s FROM orders),
units AS (
  SELECT machine, s - s % 3600 AS h, count(l_linenumber) AS units_unloaded
  FROM unloads LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
rollup AS (
  SELECT orb_site, machine_name, machine, h, make_timestamp(h * 1000000) AS start_ts,
         make_timestamp((h + 3599) * 1000000) AS end_ts, timezone,
         operating_seconds, downtime_seconds, blocked_seconds,
         total_attempts, complete_attempts, units_unloaded
  FROM machines CROSS JOIN spine
  LEFT JOIN states USING (machine, h) LEFT JOIN attempts USING (machine, h)
  LEFT JOIN complete USING (machine, h) LEFT JOIN units USING (machine, h)),
result AS (
  SELECT orb_site, machine_name, strftime(start_ts, '%Y-%m-%d %H') AS date_hour,
         {_TEXT.format("start_ts")} AS start_time,
         (h - {HOURS.lower}) // 3600 AS id_hours,
         {_TEXT.format("end_ts")} AS end_time, timezone,
         operating_seconds, downtime_seconds, blocked_seconds,
         total_attempts, complete_attempts, units_unloaded,
         {_TEXT.format(_LOCAL.format(zone="timezone", ts="start_ts"))} AS local_start_time,
         {_TEXT.format(_LOCAL.format(zone="timezone", ts="end_ts"))} AS local_end_time
  FROM rollup)"""

_METRICS = [*CLASSES, "total_attempts", "complete_attempts", "units_unloaded"]
_SHOWN = ", ".join(f"coalesce({c}, 0) AS {c}" if c in _METRICS else c for c in REPORT_COLUMNS)


def _rejects_sql() -> str:
    return f"""
WITH {_PIECES},
log AS (
  SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN s END AS s,
         CASE WHEN event_id % 7 <> 0 THEN e - 1800 END AS e FROM intervals)
SELECT event_id, CASE WHEN s IS NULL THEN 'no start' WHEN e IS NULL THEN 'no end'
                      ELSE 'reversed' END AS reject_reason
FROM log WHERE s IS NULL OR e IS NULL OR e < s"""


def _coverage_sql() -> str:
    inside = f"h BETWEEN {HOURS.lower} AND {HOURS.upper} - 1"
    timed = "{1} WHEN {0} % 10 = 0 THEN 'no_time' END"
    return f"""
WITH {_PIECES},
amounts AS (
  SELECT machine, h, seconds AS amount, NULL AS lost,
         CASE {" ".join(
             "WHEN event_type IN ({}) THEN '{}'".format(
                 ", ".join(f"'{state}'" for state in states), metric)
             for metric, states in CLASSES.items())} END AS metric
  FROM pieces
  UNION ALL SELECT machine, s, 1, {timed.format("event_id", "CASE")}, 'total_attempts' FROM intervals
  UNION ALL SELECT machine, s, 1, {timed.format("event_id", "CASE")}, 'complete_attempts'
  FROM intervals WHERE event_type = 'purchase'
  UNION ALL SELECT o_custkey % 25, {HOURS.lower} + (o_orderkey * 997) % 2700000, 1,
                   {timed.format("o_orderkey", "CASE WHEN o_orderkey % 7 = 0 THEN 'no_parent'")}, 'units_unloaded'
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT metric, CAST(sum(amount) AS BIGINT) AS total,
       CAST(coalesce(sum(amount) FILTER (lost IS NULL AND machine <> 7 AND {inside}), 0) AS BIGINT) AS in_rollup,
       CAST(coalesce(sum(amount) FILTER (lost IS NULL AND machine = 7), 0) AS BIGINT) AS unregistered,
       CAST(coalesce(sum(amount) FILTER (lost IS NULL AND machine <> 7 AND NOT ({inside})), 0) AS BIGINT) AS outside_hours,
       CAST(coalesce(sum(amount) FILTER (lost = 'no_time'), 0) AS BIGINT) AS no_time,
       CAST(coalesce(sum(amount) FILTER (lost = 'no_parent'), 0) AS BIGINT) AS no_parent
FROM amounts WHERE metric IS NOT NULL GROUP BY metric"""


def oracle_sql() -> dict[str, str]:
    return hourly_sql() | MORE_SQL


def hourly_sql() -> dict[str, str]:
    bucket = _HOUR_TEXT.format("h")
    start_bucket = _HOUR_TEXT.format("(s - s % 3600)")
    return {
        "hour_spine": f"""
WITH bounds AS (
  SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
spine AS (SELECT lo, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS start_ts FROM bounds)
SELECT {_TEXT.format("start_ts")} AS start_time,
       (epoch_us(start_ts) - epoch_us(lo)) // 3600000000 AS id_hours,
       strftime(start_ts, '%Y-%m-%d %H') AS date_hour,
       {_TEXT.format("start_ts + INTERVAL 3599 SECOND")} AS end_time
FROM spine""",
        "hour_spine_range": f"""
WITH spine AS (SELECT unnest(generate_series({HOURS.lower}, {HOURS.upper} - 1, 3600)) AS h),
counts AS (
  SELECT epoch_us(date_trunc('hour', ts)) // 1000000 AS h, count(event_id) AS events FROM events GROUP BY 1)
SELECT {_HOUR_TEXT.format("h")} AS start_time, (h - {HOURS.lower}) // 3600 AS id_hours,
       strftime(make_timestamp(h * 1000000), '%Y-%m-%d %H') AS date_hour,
       {_HOUR_TEXT.format("(h + 3599)")} AS end_time, events
FROM spine LEFT JOIN counts USING (h)""",
        "entity_registry": f"WITH {_SUPPLIERS} SELECT * FROM suppliers",
        "duplicate_keys": """
SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
        "entity_hour_grid": f"""
WITH {_SUPPLIERS}
SELECT orb_site, machine_name, strftime(make_timestamp(h * 1000000), '%Y-%m-%d %H') AS date_hour
FROM suppliers,
     (SELECT unnest(generate_series({HOURS.lower}, {HOURS.upper} - 1, 3600)) AS h)""",
        "epoch_to_ts": """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'bad'
                               ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS BIGINT) AS epoch
FROM events""",
        "split_intervals": f"""
WITH {_PIECES}
SELECT event_id, {bucket} AS bucket, CAST(seconds AS INTEGER) AS seconds,
       CAST(seconds // 60 AS INTEGER) AS minutes
FROM pieces""",
        "interval_rejects": _rejects_sql(),
        "event_rejects": """
SELECT event_id, event_type, 'no time' AS reject_reason FROM events WHERE event_id % 10 = 0""",
        "state_seconds_by_hour": f"""
WITH {_PIECES}
SELECT machine, {bucket} AS bucket, {_SECONDS}
FROM pieces WHERE event_type IN ({_STATES}) GROUP BY machine, h""",
        "events_by_hour": f"""
WITH {_PIECES}
SELECT machine, {start_bucket} AS bucket, count(event_id) AS events
FROM intervals GROUP BY ALL""",
        "events_by_hour_where": f"""
WITH {_PIECES}
SELECT machine, {start_bucket} AS bucket, count(event_id) AS events
FROM intervals WHERE event_type = 'purchase' GROUP BY ALL""",
        "child_count_by_hour": f"""
SELECT o_custkey % 25 AS machine,
       {_TEXT.format("date_trunc('hour', o_orderdate)")} AS bucket,
       count(l_linenumber) AS children
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
        "child_count_null_keys": f"""
SELECT o_custkey % 25 AS machine,
       {_TEXT.format("date_trunc('hour', o_orderdate)")} AS bucket,
       count(l_linenumber) AS children
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND o_orderkey % 3 <> 0 GROUP BY ALL""",
        "child_orphans": f"""
WITH lines AS (
  SELECT o_orderkey % 7 = 0 AS orphan, {HOURS.lower} + (o_orderkey * 997) % 2700000 < {HOURS.upper} AS inside
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT 'units_unloaded' AS metric, count(*) AS total, count(*) FILTER (NOT orphan AND inside) AS in_rollup,
       CAST(0 AS BIGINT) AS unregistered, count(*) FILTER (NOT orphan AND NOT inside) AS outside_hours,
       CAST(0 AS BIGINT) AS no_time, count(*) FILTER (orphan) AS no_parent
FROM lines""",
        "hourly_rollup": f"{_ROLLUP} SELECT * FROM result",
        "coverage": _coverage_sql(),
        "with_local_time": f"""
WITH {_SITES}, {_PIECES}
SELECT event_id, timezone, {_TEXT.format("ts")} AS ts,
       {_TEXT.format(_LOCAL.format(zone="timezone", ts="ts"))} AS local_ts,
       {_TEXT.format(_LOCAL.format(zone="timezone", ts="make_timestamp(e * 1000000)"))} AS local_end
FROM intervals JOIN machines USING (machine)""",
        "report_view": f"""
{_ROLLUP} SELECT {_SHOWN} FROM result
WHERE orb_site = '{REPORT_SITE}' AND start_time >= '{REPORT_SINCE}'
ORDER BY orb_site, machine_name, start_time LIMIT 500""",
        "write_rollup": f"{_ROLLUP} SELECT * FROM result",
        "write_daily": f"""
{_ROLLUP} SELECT * REPLACE (id_hours - {FIRST_HALF.count} AS id_hours) FROM result
WHERE id_hours >= {FIRST_HALF.count}""",
        "daily_intervals": f"""
WITH spans AS (
  SELECT user_id % 25 AS machine, event_type, epoch_us(ts) // 1000000 AS s,
         epoch_us(ts) // 1000000 + (event_id * 997) % 14400
           + CASE WHEN event_id % 7 = 0 THEN (event_id % 13) * 86400 ELSE 0 END AS e
  FROM events WHERE event_id % 30 <> 1),
hours AS (SELECT *, unnest(generate_series(s - s % 3600, e - 1, 3600)) AS h FROM spans WHERE e > s),
pieces AS (
  SELECT *, least(e, h + 3600) - greatest(s, h) AS seconds FROM hours
  WHERE h BETWEEN {TWO_DAYS.lower} AND {TWO_DAYS.upper} - 1)
SELECT machine, {bucket} AS bucket, {_SECONDS} FROM pieces
WHERE event_type IN ({_STATES}) GROUP BY machine, h""",
    }
