"""Vectors in Arrow batches: what the operators on embeddings share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def sound_rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dimension, row numbers, matrix)`` for each length of vector in the batch.

    Null vectors, empty ones and those that hold a null, a NaN or an infinity are left out.
    """
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dim)
        matrix = flat[starts[rows][:, None] + np.arange(dim)]
        good = np.isfinite(matrix).all(axis=1)
        yield dim, rows[good], matrix[good]

