"""Column functions for epochs, hour buckets and local time.

A bucket is the half-open hour [h, h + 3600 s), named by its first instant. Buckets come
from epoch arithmetic, so they do not depend on the session zone; labels and local
times do, which is why ``require_utc`` exists.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The length of a bucket, the instants Spark can print (years 0001 to
# 9999, in epoch seconds), the label format and the names under which a session zone
# is UTC.
HOUR = 3600
FIRST_EPOCH = -62135596800
LAST_EPOCH = 253402300799
LABEL_FORMAT = "yyyy-MM-dd HH"
UTC_NAMES = frozenset(
    ["UTC", "Etc/UTC", "UCT", "Etc/UCT", "GMT", "Etc/GMT", "Zulu", "Etc/Zulu",
     "Universal", "Etc/Universal", "Z", "+00:00", "UTC+00:00", "GMT+00:00"]
)


def require_utc(spark: SparkSession) -> None:
    """Fail unless the session zone is UTC.

    Hour labels follow the session zone, and ``from_utc_timestamp`` is right only when
    that zone is UTC; anywhere else a label may also name two hours at a DST change.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


def epoch_to_ts(epoch: Column) -> Column:
    """Epoch seconds, as text or number, to a timestamp.

    Fractions are kept. NULL, text that is no number, and instants outside the years
    0001 to 9999 give NULL under ANSI and non-ANSI sessions alike.
    """
    seconds = epoch.try_cast("double")
    return F.when(seconds.between(FIRST_EPOCH, LAST_EPOCH), F.timestamp_seconds(seconds))


def whole_seconds(ts: Column) -> Column:
    """Epoch seconds of a timestamp, rounded down; a zone-less one is taken as UTC."""
    return F.unix_seconds(ts.cast("timestamp"))


def hour_floor(seconds: Column) -> Column:
    """Epoch second of the start of the hour, also before 1970."""
    return seconds - F.pmod(seconds, F.lit(HOUR))


def hour_bucket(ts: Column) -> Column:
    """Start of the hour that holds ``ts``."""
    return F.timestamp_seconds(hour_floor(whole_seconds(ts)))


def hour_label(ts: Column) -> Column:
    """``yyyy-MM-dd HH``, so that text order is time order."""
    return F.date_format(ts, LABEL_FORMAT)


def local_time(ts: Column, zone: Column) -> Column:
    """The wall clock of ``zone`` (an IANA name, per row) at the UTC instant ``ts``."""
    return F.from_utc_timestamp(ts, zone)
