"""Vectors of floating-point numbers as rows of exact integers, for the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Integers stay below this, so that a squared distance of up to 128 components fits into 64 bits.
LIMIT = 1 << 27


def is_whole(vector: str) -> Column:
    """Whether a vector is there and holds neither nulls nor numbers that aren't finite."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def whole_vectors(column: pa.Array, scale: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lists of a column are whole (is_whole) and have dim components, and floor(scale * x) of those lists' components x.

    A number that doesn't fit (LIMIT) is an error: its distances wouldn't fit into 64 bits.
    """
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
    row = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
    keep = (lengths == dim) & (np.bincount(row[~np.isfinite(values)], minlength=len(lengths)) == 0)
    scaled = np.floor(values[keep[row]] * scale).reshape(-1, dim)
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component times {scale} is {LIMIT} or more")
    return keep, scaled.astype(np.int64)


def summed_by(groups: np.ndarray, rows: np.ndarray, out: np.ndarray) -> None:
    """Adds each of rows to out[its group], in integers."""
    order = np.argsort(groups, kind="stable")
    of = groups[order]
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    if len(starts):
        out[of[starts]] += np.add.reduceat(rows[order], starts, axis=0)
