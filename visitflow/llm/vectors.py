"""Vector columns as numpy matrices, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, float64 matrix) for each vector length of a list column.
    NULL and empty vectors and those with a NULL or non-finite entry are left
    out."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    first = np.cumsum(length) - length
    bad = np.bincount(np.repeat(np.arange(len(length)), length)[~np.isfinite(flat)], minlength=len(length)) > 0
    for size in np.unique(length[(length > 0) & ~bad]).tolist():
        rows = np.flatnonzero((length == size) & ~bad)
        yield rows, flat[first[rows][:, None] + np.arange(size)]
