"""The time spine, and the dense entity x hour grid built on it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.functions import HOUR, hour_floor, hour_label, require_utc, whole_seconds

BUCKET = "bucket"
HOURS_PER_DAY = 24
SPINE_ROWS_PER_TASK = 1_000_000
SPINE_BLOCK = 8192


def epoch_of(instant: str | datetime) -> int:
    """Whole epoch seconds of an ISO text or a datetime; UTC where no zone is given."""
    if isinstance(instant, str):
        instant = datetime.fromisoformat(instant)
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=timezone.utc)
    return math.floor(instant.timestamp())


@dataclass(frozen=True)
class HourRange:
    """``count`` instants one hour apart, the first at epoch second ``first``."""

    first: int
    count: int

    @classmethod
    def between(cls, start: str | datetime, end: str | datetime) -> HourRange:
        """Every hour from ``start`` up to ``end``, both included. Naive times are UTC."""
        first, last = epoch_of(start), epoch_of(end)
        if last < first:
            raise ValueError(f"the range ends before it starts: {start} .. {end}")
        return cls(first, (last - first) // HOUR + 1)

    def since(self, instant: str | datetime) -> HourRange:
        """The part of the range that starts at ``instant`` or later."""
        skipped = max(0, -((self.first - epoch_of(instant)) // HOUR))
        if skipped >= self.count:
            raise ValueError(f"no hour of the range starts at or after {instant}")
        return HourRange(self.first + skipped * HOUR, self.count - skipped)

    @property
    def lower(self) -> int:
        """Epoch second at which the first bucket starts."""
        return self.first - self.first % HOUR

    @property
    def upper(self) -> int:
        """Epoch second at which the last bucket ends (exclusive)."""
        return self.lower + self.count * HOUR

    @property
    def lower_ts(self) -> Column:
        return F.timestamp_seconds(F.lit(self.lower))

    @property
    def upper_ts(self) -> Column:
        return F.timestamp_seconds(F.lit(self.upper))

    def holds(self, ts: Column) -> Column:
        """Whether ``ts`` lies in the range; on a stored column it reaches the scan."""
        return (ts >= self.lower_ts) & (ts < self.upper_ts)


def _hour_columns(start: str, id_hours: str) -> list[Column]:
    """Columns of one spine row, from SQL text for its start and its number. ``end_time``
    is the last second of the hour."""
    return [
        F.expr(f"{start} AS start_time"),
        F.expr(f"{id_hours} AS id_hours"),
        hour_label(F.expr(start)).alias("date_hour"),
        F.expr(f"timestamp_seconds(unix_seconds({start}) + {HOUR - 1}) AS end_time"),
    ]


def hour_spine(spark: SparkSession, hours: HourRange) -> DataFrame:
    """One row per hour of ``hours``: start_time, id_hours, date_hour, end_time.

    ``id_hours`` counts 0 .. n-1 by arithmetic, so it is the same on any number of
    partitions and when a lost task runs again.
    """
    require_utc(spark)
    tasks = -(-hours.count // SPINE_ROWS_PER_TASK)
    start = f"timestamp_seconds({hours.first} + id * {HOUR})"
    return spark.range(0, hours.count, 1, tasks).select(*_hour_columns(start, "id"))


def hour_spine_over(log: DataFrame, ts: str) -> DataFrame:
    """The spine from the hour of the earliest ``ts`` in ``log`` to that of the latest.

    One aggregate over the one column and no action; an empty log gives no rows. The range
    is widened to blocks of hours, these are spread over the tasks and widened there, so one
    stray instant in a far year makes no task that holds the whole spine.
    """
    require_utc(log.sparkSession)
    bounds = log.agg(
        hour_floor(whole_seconds(F.min(ts))).alias("first"),
        hour_floor(whole_seconds(F.max(ts))).alias("last"),
    )
    tasks = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = (
        bounds.selectExpr("first", f"(last - first) div {HOUR} AS _last")
        .selectExpr("*", f"explode(sequence(0L, _last, {SPINE_BLOCK}L)) AS _block")
        .repartition(tasks, "_block")
        .selectExpr("first", f"explode(sequence(_block, least(_last, _block + {SPINE_BLOCK - 1}), 1L)) AS id")
    )
    return numbered.select(*_hour_columns(f"timestamp_seconds(first + id * {HOUR})", "id"))


def entity_buckets(registry: DataFrame, hours: HourRange, keys: Sequence[str]) -> DataFrame:
    """Every registry row with every ``bucket`` of ``hours``.

    Hours are generated from each registry row instead of joined to it, so nothing is
    broadcast and the registry may be of any size. A registry often arrives in one
    partition, or by site; rows are spread by their keys, widened to days, spread by
    (keys, day), and only then widened to hours, so that no task makes the whole grid, nor
    the days of a whole site.
    """
    columns = registry.columns
    days = f"sequence(0L, {(hours.count - 1) // HOURS_PER_DAY}L)"
    first = f"{hours.lower} + _day * {HOURS_PER_DAY * HOUR}"
    last = f"least({first} + {(HOURS_PER_DAY - 1) * HOUR}, {hours.upper - HOUR})"
    return (
        registry.repartition(*keys)
        .selectExpr("*", f"explode({days}) AS _day")
        .repartition(*keys, "_day")
        .select(*columns, F.expr(f"explode(sequence({first}, {last}, {HOUR}L)) AS _s"))
        .select(*columns, F.expr(f"timestamp_seconds(_s) AS {BUCKET}"))
    )


def hour_columns(hours: HourRange) -> list[Column]:
    """The spine's columns, from the ``bucket`` of a row."""
    late = hours.first - hours.lower
    start = f"timestamp_seconds(unix_seconds({BUCKET}) + {late})" if late else BUCKET
    return _hour_columns(start, f"(unix_seconds({BUCKET}) - {hours.lower}) div {HOUR}")


def entity_hour_grid(registry: DataFrame, hours: HourRange, keys: Sequence[str]) -> DataFrame:
    """Every registry row with every hour: the registry's columns, then the spine's."""
    require_utc(registry.sparkSession)
    return entity_buckets(registry, hours, keys).select(*registry.columns, *hour_columns(hours))
