"""Vectors of an Arrow list column as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False))


def matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix in doubles) for each length that the vectors have."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[offsets[rows][:, None] + np.arange(length)]


def lists(matrix: np.ndarray, kind) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix, kind).ravel()))
