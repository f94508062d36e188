"""Readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourgrid.functions import epoch_to_ts
from hourgrid.operators.spine import HourRange


TEXT = "_text"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, *, sep: str = ","
) -> DataFrame:
    """CSV files with a header line, read under ``schema``.

    The header is checked against the schema, so a file whose columns moved fails
    instead of being read into the wrong fields. Blank lines are skipped.
    """
    return spark.read.csv(path, schema=schema, header=True, sep=sep, enforceSchema=False)


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """Parquet files read under ``schema``: name only the columns in use.

    Declare zone-less timestamps as ``timestamp``; under a UTC session they are the same
    instants, and comparisons with them reach the scan.
    """
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).parquet(*paths)


def with_epochs(log: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn epoch-second columns into timestamps in place; bad values become NULL. What was
    there stays as ``<name>_text``, so that rejects can show it."""
    texts = {f"{name}{TEXT}": F.col(name).cast("string") for name in columns}
    return log.withColumns(texts | {name: epoch_to_ts(F.col(name)) for name in columns})


def within_days(
    log: DataFrame, day: str, hours: HourRange, *, spans: bool = False, reach: str | int | None = None
) -> DataFrame:
    """Prune a log partitioned by the UTC date its rows start on, in column ``day``.

    Point events need the days of ``hours`` only. Intervals (``spans``) may have begun
    before: ``reach`` says for how many days after its first an interval may go on. That is
    a column the log is partitioned by too, as ``write_intervals`` makes it, or a number
    that holds for all of them, which the caller vouches for. Without it any earlier day
    may matter, and only later days are pruned.
    """
    first, last = F.to_date(hours.lower_ts), F.to_date(F.timestamp_seconds(F.lit(hours.upper - 1)))
    kept = F.col(day) <= last
    if not spans:
        kept &= F.col(day) >= first
    elif reach is not None:
        days = F.col(reach) if isinstance(reach, str) else F.lit(reach)
        kept &= F.date_add(F.col(day), days) >= first
    return log.filter(kept)
