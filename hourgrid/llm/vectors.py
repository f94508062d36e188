"""Vectors in tasks: which take part, and their cosines in double precision."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether a vector has a direction: not null, no component null or non-finite, some
    component other than zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of equal length as doubles, each times a power of two that keeps its squares from
    over- and underflow; a cosine doesn't change by that, not even in its last bit."""
    rows = np.array(column.tolist(), dtype=np.float64)
    if not len(rows):
        return rows.reshape(0, 0)
    _, exponent = np.frexp(np.abs(rows).max(axis=1))
    return np.ldexp(rows, -exponent[:, None])


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the same two rows give the same number wherever they stand."""
    return np.einsum("ij,ij->i", a, b) / (norms(a) * norms(b))
