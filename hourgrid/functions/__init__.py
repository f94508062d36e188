from hourgrid.functions.time import (
    HOUR,
    epoch_to_ts,
    hour_bucket,
    hour_floor,
    hour_label,
    local_time,
    require_utc,
    whole_seconds,
)

__all__ = [
    "HOUR",
    "epoch_to_ts",
    "hour_bucket",
    "hour_floor",
    "hour_label",
    "local_time",
    "require_utc",
    "whole_seconds",
]
