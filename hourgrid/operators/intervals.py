"""Splitting intervals at hour boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.functions import HOUR, whole_seconds
from hourgrid.operators.spine import BUCKET, HourRange

BLOCK = 1024 * HOUR


def split_intervals(
    log: DataFrame,
    *,
    start: str,
    end: str,
    hours: HourRange | None = None,
    keep_outside: bool = False,
) -> DataFrame:
    """One row per interval and hour it touches: the log's columns, ``bucket``,
    ``seconds`` spent in that hour (1 .. 3600) and whole ``minutes`` of them.

    Times count in whole seconds, rounded down. For an hour starting at h the seconds
    are ``least(end, h + 3600) - greatest(start, h)``; an interval that ends on the hour
    has no part in the next one, and an empty interval gives no row. NULL and reversed
    intervals give no row either; ``interval_rejects`` lists them. Overlapping intervals
    are independent rows.

    ``hours`` limits the work: intervals outside it are dropped at the scan, and the
    others are widened only to the hours inside it, so an open end far in the future
    costs no more than the range is long. With ``keep_outside`` each interval adds one
    row with a NULL bucket for the seconds that lie outside.
    """
    spans = log
    if hours is not None and not keep_outside:
        # On the stored columns, for the scan; the whole-second test below is the exact one.
        spans = spans.filter(
            f"`{start}` < timestamp_seconds({hours.upper}) "
            f"AND `{end}` > timestamp_seconds({hours.lower})"
        )
    spans = spans.selectExpr(
        "*",
        f"unix_seconds(timestamp(`{start}`)) AS _s",
        f"unix_seconds(timestamp(`{end}`)) AS _e",
    ).filter("_e > _s")

    first, last = f"_s - pmod(_s, {HOUR})", f"_e - 1 - pmod(_e - 1, {HOUR})"
    seconds = f"least(_e, _bucket + {HOUR}) - greatest(_s, _bucket)"
    if hours is None:
        blocks = f"sequence({first}, {last}, {BLOCK}L)"
    else:
        first = f"greatest({first}, {hours.lower})"
        last = f"least({last}, {hours.upper - HOUR})"
        blocks = f"sequence({first}, {last}, {BLOCK}L)"
        inside = f"least(_e, {hours.upper}) - greatest(_s, {hours.lower})"
        if keep_outside:
            spans = spans.selectExpr("*", f"greatest({inside}, 0) AS _inside")
            blocks = (
                f"concat(if(_inside > 0, {blocks}, array()), "
                "if(_e - _s > _inside, array(CAST(NULL AS bigint)), array()))"
            )
            seconds = f"if(_bucket IS NULL, _e - _s - _inside, {seconds})"
        else:
            spans = spans.filter(f"{inside} > 0")

    # In two steps, so that no array is longer than a block or the number of blocks; the
    # outer form keeps the NULL block of the seconds outside.
    buckets = f"sequence(_block, least(_last, _block + {BLOCK - HOUR}), {HOUR}L)"
    number = "bigint" if keep_outside else "int"
    return (
        spans.selectExpr("*", f"{last} AS _last", f"explode({blocks}) AS _block")
        .selectExpr("*", f"explode_outer({buckets}) AS _bucket")
        .select(
            *log.columns,
            F.expr(f"timestamp_seconds(_bucket) AS {BUCKET}"),
            F.expr(f"CAST({seconds} AS {number}) AS seconds"),
        )
        .selectExpr("*", f"CAST(seconds / 60 AS {number}) AS minutes")
    )


def event_rejects(log: DataFrame, *, ts: str) -> DataFrame:
    """Rows whose ``ts`` is NULL, or was no time, with the ``reject_reason`` ``no time``. They
    enter no hour."""
    return log.filter(F.col(ts).isNull()).withColumn("reject_reason", F.lit("no time"))


def interval_rejects(log: DataFrame, *, start: str, end: str) -> DataFrame:
    """Rows ``split_intervals`` cannot use, with a ``reject_reason``: ``no start``,
    ``no end`` (NULL or not a time) or ``reversed``."""
    reason = (
        F.when(F.col(start).isNull(), "no start")
        .when(F.col(end).isNull(), "no end")
        .when(whole_seconds(F.col(end)) < whole_seconds(F.col(start)), "reversed")
    )
    return log.withColumn("reject_reason", reason).filter("reject_reason is not null")
