from hourgrid.operators.intervals import event_rejects, interval_rejects, split_intervals
from hourgrid.operators.metrics import (
    child_count_by_hour,
    child_leg,
    event_leg,
    events_by_hour,
    hourly_sums,
    state_leg,
    state_seconds_by_hour,
)
from hourgrid.operators.registry import duplicate_keys, entity_registry
from hourgrid.operators.report import report_view
from hourgrid.operators.rollup import coverage, hourly_rollup, with_local_time
from hourgrid.operators.spine import (
    BUCKET,
    HourRange,
    entity_hour_grid,
    epoch_of,
    hour_spine,
    hour_spine_over,
)

__all__ = [
    "BUCKET",
    "HourRange",
    "child_count_by_hour",
    "child_leg",
    "coverage",
    "duplicate_keys",
    "entity_hour_grid",
    "entity_registry",
    "epoch_of",
    "event_leg",
    "event_rejects",
    "events_by_hour",
    "hour_spine",
    "hour_spine_over",
    "hourly_rollup",
    "hourly_sums",
    "interval_rejects",
    "report_view",
    "split_intervals",
    "state_leg",
    "state_seconds_by_hour",
    "with_local_time",
]
