"""Hourly metrics.

Each metric comes in two forms. A *leg* holds one row per log row (or per piece of it)
with the keys, the ``bucket`` and what the row adds to each metric; a ``*_by_hour`` table
is that leg summed. Legs are what the rollup takes. A leg carries every metric of its log,
so the log is read, split, shuffled and joined once, not once per metric.

A sum over no rows is NULL, and a leg writes NULL where a row does not bear on a metric.
So "nothing happened" stays NULL and "it happened and came to zero" is 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.functions import hour_bucket
from hourgrid.operators.intervals import split_intervals
from hourgrid.operators.spine import BUCKET, HourRange

# Column of legs that keep what the rollup leaves out: why a row has no place in any hour.
LOST = "_lost"
NO_TIME, NO_PARENT = "no_time", "no_parent"


def hourly_sums(leg: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum every metric of a leg by (keys, bucket).

    Spark sums inside each map task before the shuffle, so a key that holds most of the
    log reaches its reducer as one row per task.
    """
    group = [*keys, BUCKET, *[LOST for name in leg.columns if name == LOST]]
    metrics = [name for name in leg.columns if name not in group]
    return leg.groupBy(*group).agg(*[F.sum(name).alias(name) for name in metrics])


def _bucketed(
    log: DataFrame, ts: str, hours: HourRange | None, keep_outside: bool
) -> tuple[DataFrame, list[Column]]:
    bucket = hour_bucket(F.col(ts))
    if hours is None:
        return log, [bucket.alias(BUCKET)]
    if keep_outside:
        lost = F.when(F.col(ts).isNull(), NO_TIME)
        return log, [F.when(hours.holds(F.col(ts)), bucket).alias(BUCKET), lost.alias(LOST)]
    return log.filter(hours.holds(F.col(ts))), [bucket.alias(BUCKET)]


def state_leg(
    log: DataFrame,
    classes: Mapping[str, Sequence[str]],
    *,
    keys: Sequence[str],
    start: str,
    end: str,
    state: str,
    hours: HourRange | None = None,
    keep_outside: bool = False,
) -> DataFrame:
    """Seconds by class of state; ``classes`` maps a metric to its states, exact and
    case-sensitive. Rows in any other state are dropped at the scan."""
    wanted = sorted({name for names in classes.values() for name in names})
    pieces = split_intervals(
        log.filter(F.col(state).isin(wanted)).select(*keys, start, end, state),
        start=start, end=end, hours=hours, keep_outside=keep_outside,
    )
    metrics = [
        F.when(F.col(state).isin(list(names)), F.col("seconds")).cast("bigint").alias(metric)
        for metric, names in classes.items()
    ]
    return pieces.select(*keys, BUCKET, *metrics)


def state_seconds_by_hour(
    log: DataFrame,
    classes: Mapping[str, Sequence[str]],
    *,
    keys: Sequence[str],
    start: str,
    end: str,
    state: str,
    hours: HourRange | None = None,
) -> DataFrame:
    """Seconds spent in each class of state by (keys, bucket), all classes in one pass.
    Overlapping intervals add up, so a bucket may pass 3600."""
    leg = state_leg(log, classes, keys=keys, start=start, end=end, state=state, hours=hours)
    return hourly_sums(leg, keys)


def event_leg(
    log: DataFrame,
    counts: Mapping[str, Column | None],
    *,
    keys: Sequence[str],
    ts: str,
    id: str,
    hours: HourRange | None = None,
    keep_outside: bool = False,
) -> DataFrame:
    """Event counts; ``counts`` maps a metric to its condition, None for every event.
    The hour is that of ``ts``, and only events with an ``id`` count."""
    log, bucket = _bucketed(log, ts, hours, keep_outside)
    counted = F.col(id).isNotNull().cast("bigint")
    metrics = [
        (counted if where is None else F.when(where, counted)).alias(metric)
        for metric, where in counts.items()
    ]
    return log.select(*keys, *bucket, *metrics)


def events_by_hour(
    log: DataFrame,
    *,
    keys: Sequence[str],
    ts: str,
    id: str,
    where: Column | None = None,
    name: str = "events",
    hours: HourRange | None = None,
) -> DataFrame:
    """Number of events by (keys, bucket of ``ts``), of those that meet ``where``."""
    if where is not None:
        log = log.filter(where)
    return hourly_sums(event_leg(log, {name: None}, keys=keys, ts=ts, id=id, hours=hours), keys)


def child_leg(
    parents: DataFrame,
    children: DataFrame,
    *,
    on: Sequence[str],
    keys: Sequence[str],
    ts: str,
    item: str,
    name: str = "children",
    hours: HourRange | None = None,
    keep_outside: bool = False,
    unique_parents: bool = False,
) -> DataFrame:
    """Children counted in the hour of their parent, joined on ``on``.

    A parent without children adds 0, a child without a parent nothing, and only
    children with an ``item`` count. Parents that repeat a key count its children once
    each, as in a plain join.

    Both sides are counted by join key before they meet. The join then has one row per
    key on the child side and one per key and hour on the parent side, so a parent
    that owns a third of the children, or a parent row copied as often, is no hot key.
    Counting parents costs them a second shuffle; ``unique_parents`` promises that none
    repeats its key (``duplicate_keys`` finds those that do) and saves it. Repeats then
    still count, but unbalanced. Parents with a NULL in ``on`` have no children; they are
    spread over the join, not sent to one task.

    With ``keep_outside``, children without a parent are there too, as such.
    """
    every, (parents, bucket) = parents, _bucketed(parents, ts, hours, keep_outside)
    parent_columns = [*on, *[key for key in keys if key not in on]]
    copies = parents.select(*parent_columns, *bucket)
    if unique_parents:
        copies = copies.withColumn("_copies", F.lit(1).cast("bigint"))
    else:
        copies = copies.groupBy(*copies.columns).agg(F.count(F.lit(1)).alias("_copies"))
    owned = children.filter(F.col(item).isNotNull()).groupBy(*on).agg(F.count(item).alias("_owned"))
    total = F.col("_copies") * F.coalesce(F.col("_owned"), F.lit(0))
    no_key = " or ".join(f"`{key}` is null" for key in on)
    spread = F.pmod(F.xxhash64(*[c for c in copies.columns if c != "_copies"]), F.lit(1024)) + 1
    spread = F.when(F.expr(no_key), spread).otherwise(F.lit(0).cast("bigint"))
    joined = copies.withColumn("_spread", spread).join(
        owned.withColumn("_spread", F.lit(0).cast("bigint")), [*on, "_spread"], "left"
    )
    kept = [LOST] if LOST in joined.columns else []
    leg = joined.select(*keys, BUCKET, *kept, total.alias(name))
    if not kept:
        return leg
    orphans = owned.join(every.select(*on).distinct(), list(on), "left_anti")
    none = {key: F.lit(None).cast(leg.schema[key].dataType).alias(key) for key in [*keys, BUCKET]}
    return leg.unionByName(
        orphans.select(
            *[F.col(key) if key in on else none[key] for key in keys], none[BUCKET],
            F.lit(NO_PARENT).alias(LOST), F.col("_owned").alias(name),
        )
    )


def child_count_by_hour(
    parents: DataFrame,
    children: DataFrame,
    *,
    on: Sequence[str],
    keys: Sequence[str],
    ts: str,
    item: str,
    name: str = "children",
    hours: HourRange | None = None,
    unique_parents: bool = False,
) -> DataFrame:
    """Number of children by (keys, bucket of the parent's ``ts``); 0 where there are
    parents but no children."""
    leg = child_leg(
        parents, children, on=on, keys=keys, ts=ts, item=item, name=name, hours=hours,
        unique_parents=unique_parents,
    )
    return hourly_sums(leg, keys)
