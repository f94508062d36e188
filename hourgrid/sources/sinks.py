"""Writing the rollup, and reading back what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from hourgrid.functions import require_utc
from hourgrid.operators.spine import HourRange
from hourgrid.sources.readers import within_days

DAY = "day"
# How many days after its first an interval goes on, rounded up: 0, 1, 2, 4, 8 and so on.
REACH = "reach_days"


def write_rollup(
    rollup: DataFrame, format: str, *, mode: str = "overwrite", **options: str
) -> None:
    """Write a rollup as it is, all columns and NULLs kept, to any Spark sink.

    ``format`` and ``options`` go to Spark unchanged: ``path`` for files; ``url``,
    ``dbtable``, ``user``, ``password``, ``numPartitions`` and ``truncate`` for
    ``jdbc``. Without ``truncate="true"`` a JDBC overwrite drops the table, with its types and
    grants. A JDBC write commits per task, so ``publish`` a table first and send what that
    returns: a lost executor then repeats only its part of the transfer.
    """
    rollup.write.format(format).options(**options).mode(mode).save()


def write_daily(rollup: DataFrame, path: str, *, mode: str = "overwrite", **options: str) -> None:
    """Write Parquet partitioned by the UTC day of ``start_time``.

    Rows are rebalanced by day first: without that every task would write a small file
    into every day, and with a plain repartition a large day would be one task. Pass
    ``partitionOverwriteMode="dynamic"`` to replace only the days at hand.
    """
    require_utc(rollup.sparkSession)
    days = rollup.withColumn(DAY, F.to_date("start_time")).hint("rebalance", F.col(DAY))
    days.write.options(**options).mode(mode).partitionBy(DAY).parquet(path)


def write_intervals(
    log: DataFrame, path: str, *, start: str, end: str, mode: str = "overwrite", **options: str
) -> None:
    """Write an interval log as Parquet, partitioned by the UTC day an interval starts on and
    by how far it reaches, so that a range of hours can be read without the days that no
    interval of which reaches it.

    The reach is a power of two, so a day has few folders however long its intervals: a year
    takes ten. An interval up to midnight does not reach the next day. Intervals without an
    end, or ending before they start, reach no other day, those without a start have no
    day; neither has a part in any hour. Rows are rebalanced as in ``write_daily``. The log
    must have no columns of the names used here, ``day`` and ``reach_days``.
    """
    require_utc(log.sparkSession)
    if taken := {name for name in log.columns if name.lower() in (DAY, REACH)}:
        raise ValueError(f"the log has columns of its own named {sorted(taken)}")
    days = f"datediff(to_date(timestamp_seconds(unix_seconds(timestamp(`{end}`)) - 1)), to_date(`{start}`))"
    reach = f"CASE WHEN {days} >= 2 THEN shiftleft(1, length(bin({days} - 1))) WHEN {days} = 1 THEN 1 ELSE 0 END"
    stored = log.withColumns({DAY: F.to_date(start), REACH: F.expr(reach)})
    stored.hint("rebalance", F.col(DAY), F.col(REACH)).write.options(**options).mode(mode).partitionBy(
        DAY, REACH
    ).parquet(path)


def read_intervals(
    spark: SparkSession, path: str, schema: StructType | str, *, hours: HourRange | None = None
) -> DataFrame:
    """Read what ``write_intervals`` wrote, under ``schema`` (the log's own columns); with
    ``hours``, only the folders whose intervals can have a part in that range."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    stored = StructType([*schema.fields, StructField(DAY, DateType()), StructField(REACH, IntegerType())])
    rows = spark.read.schema(stored).parquet(path)
    if hours is not None:
        rows = within_days(rows, DAY, hours, spans=True, reach=REACH)
    return rows.drop(DAY, REACH)


def read_daily(
    spark: SparkSession, path: str, schema: StructType | str, *, hours: HourRange | None = None
) -> DataFrame:
    """Read what ``write_daily`` wrote, under ``schema`` (the rollup's own columns); with
    ``hours``, only the days and hours in that range."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    stored = StructType([*schema.fields, StructField(DAY, DateType())])
    rows = spark.read.schema(stored).parquet(path)
    if hours is not None:
        rows = within_days(rows, DAY, hours).filter(hours.holds(F.col("start_time")))
    return rows.drop(DAY)


def publish(
    rollup: DataFrame, path: str, *, hours: HourRange | None = None, mode: str = "overwrite", **options: str
) -> DataFrame:
    """Write a rollup with ``write_daily`` and return it as read back, so that reports and
    transfers made from it do not compute it again.

    Only ``hours``, the range of the rollup, is read back; without it the folder must be
    overwritten as a whole. Nothing can be appended, as days that are there already could
    not be told from those written.
    """
    if mode == "append":
        raise ValueError("publish replaces days; append with write_daily")
    replaced = {key.lower(): value for key, value in options.items()}.get(
        "partitionoverwritemode", rollup.sparkSession.conf.get("spark.sql.sources.partitionOverwriteMode")
    )
    if hours is None and (mode != "overwrite" or replaced.lower() == "dynamic"):
        raise ValueError("name the hours of the rollup, as the folder may hold others")
    write_daily(rollup, path, mode=mode, **options)
    return read_daily(rollup.sparkSession, path, rollup.schema, hours=hours)
