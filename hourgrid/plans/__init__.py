from hourgrid.plans.machines import (
    MachineLogs,
    machine_coverage,
    machine_event_rejects,
    machine_rejects,
    machine_report,
    machine_rollup,
)

__all__ = [
    "MachineLogs",
    "machine_coverage",
    "machine_event_rejects",
    "machine_rejects",
    "machine_report",
    "machine_rollup",
]
