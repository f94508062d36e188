"""The dense rollup: legs summed once, joined to the grid, with local times."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions import local_time, require_utc
from hourgrid.operators.metrics import LOST, NO_PARENT, NO_TIME, hourly_sums
from hourgrid.operators.spine import BUCKET, HourRange, entity_buckets, hour_columns


def with_local_time(df: DataFrame, columns: Mapping[str, str], zone: str) -> DataFrame:
    """Add the wall-clock time of UTC timestamps; ``columns`` maps each new name to its
    source, and the zone is read from column ``zone`` of the same row."""
    require_utc(df.sparkSession)
    return df.withColumns(
        {name: local_time(F.col(source), F.col(zone)) for name, source in columns.items()}
    )


def hourly_rollup(
    registry: DataFrame,
    hours: HourRange,
    legs: Sequence[DataFrame],
    *,
    keys: Sequence[str],
    zone: str = "timezone",
    order_by: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One row per registry row and hour: keys, date_hour, start_time, id_hours, end_time,
    the rest of the registry, every metric (NULL where nothing happened), and the local
    start and end.

    Each leg is summed on its own, before any join: at most one row per entity and hour is
    left of it, and those partitions are the ones the join needs. The join is on the bucket
    instant; ``date_hour`` is only its label. What lies outside the hours or the registry
    is not in the result; ``coverage`` counts it.

    With ``order_by`` (columns of the registry, or ``start_time``) and ``limit``, the first
    rows in that order only. No leg adds or drops a row, so these are taken from the grid
    before any join: the joins then meet that many rows, whatever the size of the grid.
    """
    require_utc(registry.sparkSession)
    attributes = [name for name in registry.columns if name not in keys]
    dense = entity_buckets(registry, hours, keys)
    if limit is not None:
        order = [BUCKET if name == "start_time" else name for name in order_by or ()]
        if unknown := set(order) - set(dense.columns):
            raise ValueError(f"the first rows are told by registry columns and start_time, not {sorted(unknown)}")
        dense = dense.orderBy(*order).limit(limit) if order else dense.limit(limit)
    metrics = []
    for leg in legs:
        sums = hourly_sums(leg, keys)
        metrics += [name for name in sums.columns if name not in (*keys, BUCKET)]
        dense = dense.join(sums, [*keys, BUCKET], "left")
    # Only the bucket crosses the shuffle; the other time columns are made from it here.
    dense = dense.select(*keys, *attributes, *metrics, *hour_columns(hours)).select(
        *keys, "date_hour", "start_time", "id_hours", "end_time", *attributes, *metrics
    )
    return with_local_time(
        dense, {"local_start_time": "start_time", "local_end_time": "end_time"}, zone
    )


def coverage(registry: DataFrame, legs: Sequence[DataFrame], *, keys: Sequence[str]) -> DataFrame:
    """Where each metric went: one row per metric with its ``total``, the part
    ``in_rollup``, and the parts lost as ``no_time`` (events, or children of parents, whose
    time is missing or malformed), ``no_parent`` (children), ``unregistered`` (no such
    entity) and ``outside_hours`` (a registered one, at another time). The parts add up to
    the total. Seconds of intervals without a time are not known; ``interval_rejects`` has
    those.

    Takes legs made with ``keep_outside=True``. Sums by key come first, so the registry
    meets at most one row per entity and hour.
    """
    activity = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [hourly_sums(leg, keys) for leg in legs],
    )
    if LOST not in activity.columns:
        activity = activity.withColumn(LOST, F.lit(None).cast("string"))
    metrics = [name for name in activity.columns if name not in (*keys, BUCKET, LOST)]
    known = registry.select(*keys).distinct().withColumn("_known", F.lit(True))
    registered, in_hours = F.col("_known").isNotNull(), F.col(BUCKET).isNotNull()
    placed = F.col(LOST).isNull()
    parts = {
        "total": F.lit(True),
        "in_rollup": placed & registered & in_hours,
        "unregistered": placed & ~registered,
        "outside_hours": placed & registered & ~in_hours,
        "no_time": F.col(LOST) == NO_TIME,
        "no_parent": F.col(LOST) == NO_PARENT,
    }
    lines = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                *[
                    F.coalesce(F.sum(F.when(part, F.col(metric))), F.lit(0)).alias(name)
                    for name, part in parts.items()
                ],
            )
            for metric in metrics
        ]
    )
    lost = activity.join(known, list(keys), "left").agg(lines.alias("lines"))
    return lost.select(F.inline("lines"))
