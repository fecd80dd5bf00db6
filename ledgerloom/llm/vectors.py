"""Vectors of a table as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def usable(column: pa.Array, zero: bool = True) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows whose vector is there and holds finite numbers only (``zero``: may be all zeros), and the vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows, vectors = [], []
    offsets = column.offsets.to_numpy()
    values = column.values.cast(pa.float64())
    present = pc.is_valid(values).to_numpy(zero_copy_only=False)
    flat = pc.fill_null(values, np.nan).to_numpy(zero_copy_only=False)
    there = pc.is_valid(column).to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        own = slice(offsets[i], offsets[i + 1])
        vector = flat[own]
        if there[i] and len(vector) and present[own].all() and np.isfinite(vector).all() and (zero or vector.any()):
            rows.append(i)
            vectors.append(vector)
    return np.array(rows, np.int64), vectors
