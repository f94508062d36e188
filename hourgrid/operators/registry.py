"""The entity registry: which machine stands at which site, in which time zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_registry(sites: DataFrame, machines: DataFrame, on: Sequence[str]) -> DataFrame:
    """Sites joined to their machines. Sites without machines and machines without a
    site drop out.

    There is no broadcast hint: Spark broadcasts the smaller table when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both beyond it.
    """
    return sites.join(machines, list(on))


def duplicate_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``copies``. A registry should have
    none: each copy repeats its grid rows in the rollup."""
    return (
        table.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
