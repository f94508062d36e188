"""The report: the first rows of a rollup in order, for reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def report_view(
    rollup: DataFrame,
    *,
    where: Column | str | None = None,
    order_by: Sequence[str],
    columns: Sequence[str],
    limit: int | None = None,
) -> DataFrame:
    """Rows that meet ``where`` (a column or SQL text), NULL numbers shown as 0, in the
    order of ``order_by``; with ``limit``, the first so many.

    The fill touches numbers only and is for display: write the rollup itself to keep
    NULL apart from 0. With a limit, sort and limit run as one top-k, without a full sort.
    """
    rows = rollup if where is None else rollup.filter(where)
    rows = rows.na.fill(0).orderBy(*order_by)
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(*columns)
