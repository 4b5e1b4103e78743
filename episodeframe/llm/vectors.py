"""Vector helpers of the two embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Whether a vector takes part: not null, not empty or zero, all components
    finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def same_vector(vec: Column) -> tuple[Column, Column]:
    """A 128-bit key of a vector's components; rows with equal keys count as copies."""
    return F.xxhash64(vec), F.xxhash64(F.lit(1), vec)


def matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) of a list column, per vector length."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], lengths.cumsum()[:-1]])
    out = []
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out.append((rows, flat[starts[rows][:, None] + np.arange(n)]))
    return out
