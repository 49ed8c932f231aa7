"""Arrow list columns to numpy matrices and back, without a Python loop over rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """Rows of equal length as a float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if len(vectors) == 0:
        return np.empty((0, 0))
    return np.asarray(flat, dtype=np.float64).reshape(len(vectors), -1)


def list_of(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    offsets = np.arange(0, rows * width + 1, width, dtype=np.int32) if rows and width else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))
