"""Declared schemas of the six input files. Nothing is inferred.

Identifiers are text and join as text (``01`` is not ``1``). Times are epoch seconds, read
as text, so that a reject can show what is no number.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def _schema(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# The header of each input file.
SITES = _schema("orb_site", "timezone")
MACHINES = _schema("meta_orb_site", "meta_machine_name")
STATES = _schema(
    "id", "start_time", "end_time", "state",
    "meta_orb_site", "meta_machine_name", "meta_event_time",
)
ATTEMPTS = _schema(
    "id", "start_time", "end_time", "outcome", "terminating_error",
    "meta_orb_site", "meta_machine_name", "meta_event_time",
)
UNLOADS = _schema(
    "unload_id", "order_id", "event_time",
    "meta_orb_site", "meta_machine_name", "meta_event_time",
)
UNLOAD_ITEMS = _schema(
    "unload_id", "item_id", "meta_orb_site", "meta_machine_name", "meta_event_time",
)
