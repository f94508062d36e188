from hourgrid.sources.readers import read_csv, read_parquet, with_epochs, within_days
from hourgrid.sources.sinks import (
    publish,
    read_daily,
    read_intervals,
    write_daily,
    write_intervals,
    write_rollup,
)

__all__ = [
    "publish",
    "read_csv",
    "read_daily",
    "read_intervals",
    "read_parquet",
    "with_epochs",
    "within_days",
    "write_daily",
    "write_intervals",
    "write_rollup",
]
