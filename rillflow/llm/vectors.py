"""Vector columns in Arrow batches: the rows that hold a whole vector, as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def dense(column: pa.Array, width: int | None = None, below: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, matrix) of the vectors in a list<double> column that are not null and hold neither nulls nor
    entries that are not finite or whose magnitude reaches ``below``; with ``width`` only vectors of that length.

    Without ``width`` all vectors must have the same length."""
    offsets = np.asarray(column.offsets)
    values = column.values
    numbers = values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(numbers) < below))])
    sizes = np.diff(offsets)
    fine = (bad[offsets[1:]] == bad[offsets[:-1]]) & np.asarray(column.is_valid())
    if width is None:
        width = int(sizes[fine][0]) if fine.any() else 0
    rows = np.flatnonzero(fine & (sizes == width))
    at = offsets[:-1][rows][:, None] + np.arange(width)[None, :]
    return rows, numbers[at] if len(rows) else np.zeros((0, width))


def lengths(column: pa.Array, below: float = np.inf) -> np.ndarray:
    """The lengths of a column's whole vectors, as ``dense`` tells them, one for each such row."""
    offsets = np.asarray(column.offsets)
    numbers = column.values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(numbers) < below))])
    fine = (bad[offsets[1:]] == bad[offsets[:-1]]) & np.asarray(column.is_valid())
    return np.diff(offsets)[fine]
