"""The complete job: six logs in, hourly machine activity out."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.operators import (
    HourRange,
    child_leg,
    coverage,
    entity_registry,
    epoch_of,
    event_leg,
    event_rejects,
    hourly_rollup,
    interval_rejects,
    report_view,
    state_leg,
)
from hourgrid.sources import read_csv, schemas, with_epochs, within_days
from hourgrid.sources.readers import TEXT

# The keys of the input logs, the states behind each metric, the outcome
# that counts as complete, and the columns of the result and of the report.
KEYS = ["meta_orb_site", "meta_machine_name"]
STATE_CLASSES = {
    "operating_seconds": ["sorting"],
    "downtime_seconds": ["scheduled_downtime", "unscheduled_downtime"],
    "blocked_seconds": ["blocked"],
}
COMPLETE = "complete"
OUTPUT_KEYS = {"meta_orb_site": "orb_site", "meta_machine_name": "machine_name"}
ROLLUP_SCHEMA = (
    "orb_site string, machine_name string, date_hour string, start_time timestamp, "
    "id_hours bigint, end_time timestamp, timezone string, operating_seconds bigint, "
    "downtime_seconds bigint, blocked_seconds bigint, total_attempts bigint, "
    "complete_attempts bigint, units_unloaded bigint, local_start_time timestamp, "
    "local_end_time timestamp"
)
REPORT_ORDER = ["orb_site", "machine_name", "start_time"]
REPORT_COLUMNS = [
    "orb_site", "machine_name", "start_time", "end_time", "local_start_time",
    "local_end_time", "units_unloaded", "total_attempts", "complete_attempts",
    "operating_seconds", "downtime_seconds", "blocked_seconds", "timezone",
]


@dataclass(frozen=True)
class MachineLogs:
    """The six inputs, with the column names of ``sources.schemas`` and times as
    timestamps. Sites carry ``meta_orb_site`` and ``timezone``. Any source will do; only
    the columns in use need to be there. ``unique_unloads`` promises that no unload comes
    twice, see ``child_leg``."""

    sites: DataFrame
    machines: DataFrame
    states: DataFrame
    attempts: DataFrame
    unloads: DataFrame
    unload_items: DataFrame
    unique_unloads: bool = False

    @classmethod
    def from_csv(
        cls,
        spark: SparkSession,
        *,
        sites: str,
        machines: str,
        states: str,
        attempts: str,
        unloads: str,
        unload_items: str,
    ) -> MachineLogs:
        """Read the six CSV files or directories; times in them are epoch seconds."""
        return cls(
            sites=read_csv(spark, sites, schemas.SITES).withColumnRenamed("orb_site", "meta_orb_site"),
            machines=read_csv(spark, machines, schemas.MACHINES),
            states=with_epochs(read_csv(spark, states, schemas.STATES), ["start_time", "end_time"]),
            attempts=with_epochs(read_csv(spark, attempts, schemas.ATTEMPTS), ["start_time", "end_time"]),
            unloads=with_epochs(read_csv(spark, unloads, schemas.UNLOADS), ["event_time"]),
            unload_items=read_csv(spark, unload_items, schemas.UNLOAD_ITEMS),
        )

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        *,
        sites: str,
        machines: str,
        states: str,
        attempts: str,
        unloads: str,
        unload_items: str,
        hours: HourRange | None = None,
        day: str = "day",
        reach: str | int | None = None,
    ) -> MachineLogs:
        """Read Parquet with the column names of ``sources.schemas`` and times as timestamps.
        With ``hours``, logs stored by ``day``, the UTC date a row starts on, are pruned to
        the days that can matter; the items of unloads have no day of their own. For the
        states that takes ``reach``, see ``within_days``: the column ``reach_days`` that
        ``write_intervals`` adds, or the most days an interval goes on after its first."""
        def log(path: str, spans: bool = False) -> DataFrame:
            rows = spark.read.parquet(path)
            return rows if hours is None else within_days(rows, day, hours, spans=spans, reach=reach)

        return cls(
            sites=spark.read.parquet(sites), machines=spark.read.parquet(machines),
            states=log(states, spans=True), attempts=log(attempts), unloads=log(unloads),
            unload_items=spark.read.parquet(unload_items),
        )

    def at_site(self, site: str) -> MachineLogs:
        """The same logs, one site only. Filter the inputs like this for a result about
        one site: a filter on the rollup reaches every scan but that of the items."""
        tables = {
            each.name: getattr(self, each.name).filter(F.col("meta_orb_site") == site)
            for each in fields(self)
            if each.name != "unique_unloads"
        }
        return replace(self, **tables)

    @property
    def registry(self) -> DataFrame:
        return entity_registry(self.sites, self.machines, ["meta_orb_site"])

    def legs(self, hours: HourRange, keep_outside: bool = False) -> list[DataFrame]:
        bounds = {"keys": KEYS, "hours": hours, "keep_outside": keep_outside}
        return [
            state_leg(
                self.states, STATE_CLASSES,
                start="start_time", end="end_time", state="state", **bounds,
            ),
            event_leg(
                self.attempts,
                {"total_attempts": None, "complete_attempts": F.col("outcome") == COMPLETE},
                ts="start_time", id="id", **bounds,
            ),
            child_leg(
                self.unloads, self.unload_items,
                on=[*KEYS, "unload_id"], ts="event_time", item="item_id",
                name="units_unloaded", unique_parents=self.unique_unloads, **bounds,
            ),
        ]


def machine_rollup(
    logs: MachineLogs, hours: HourRange, *, site: str | None = None, limit: int | None = None
) -> DataFrame:
    """One row per machine and hour, in the columns of ``ROLLUP_SCHEMA``; with ``site``, of that
    site, which then filters all six inputs; with ``limit``, the first rows in the order of the
    report, taken before the logs are joined."""
    if site is not None:
        logs = logs.at_site(site)
    by_name = {new: old for old, new in OUTPUT_KEYS.items()}
    rollup = hourly_rollup(
        logs.registry, hours, logs.legs(hours), keys=KEYS,
        order_by=[by_name.get(name, name) for name in REPORT_ORDER], limit=limit,
    )
    return rollup.withColumnsRenamed(OUTPUT_KEYS)


def machine_report(
    rollup: DataFrame,
    *,
    since: str | datetime | None = None,
    where: Column | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """The rows of a rollup by site, machine and hour, for reading; with ``limit``, the first.

    Give it a written rollup where there is one. On a rollup still to be computed, cut
    ``hours`` with ``HourRange.since`` as well: ``since`` filters rows of the result,
    the range limits what is read for them. Where that range and a site are all that is
    asked for, give ``machine_rollup`` the ``limit`` too.
    """
    if since is not None:
        rollup = rollup.filter(F.col("start_time") >= F.timestamp_seconds(F.lit(epoch_of(since))))
    return report_view(
        rollup, where=where, order_by=REPORT_ORDER, columns=REPORT_COLUMNS, limit=limit
    )


def machine_coverage(logs: MachineLogs, hours: HourRange) -> DataFrame:
    """How much of each metric the rollup over ``hours`` holds, and where the rest is."""
    return coverage(logs.registry, logs.legs(hours, keep_outside=True), keys=KEYS)


def machine_rejects(logs: MachineLogs) -> DataFrame:
    """State intervals that enter no metric because a time is missing or reversed."""
    return interval_rejects(logs.states, start="start_time", end="end_time")


def machine_event_rejects(logs: MachineLogs) -> DataFrame:
    """Attempts and unloads that enter no hour because their time is missing or malformed:
    ``log, id``, the keys, the time as it was read (NULL where the text is not known), and
    the reason."""
    parts = []
    for name, rows, id, ts in (
        ("attempts", logs.attempts, "id", "start_time"), ("unloads", logs.unloads, "unload_id", "event_time"),
    ):
        text = F.col(f"{ts}{TEXT}") if f"{ts}{TEXT}" in rows.columns else F.lit(None).cast("string")
        parts.append(
            event_rejects(rows, ts=ts).select(
                F.lit(name).alias("log"), F.col(id).cast("string").alias("id"), *KEYS,
                text.alias("time_text"), "reject_reason",
            )
        )
    return parts[0].unionByName(parts[1])
