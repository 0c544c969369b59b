"""Which vectors can be compared, and how they travel to Python workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for vectors without null, NaN or infinite components; never null."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return F.coalesce(~bad, F.lit(False))


def nonzero(vector: Column) -> Column:
    return F.exists(vector, lambda x: x != 0)


def matrix(column: pa.ChunkedArray | pa.Array, dims: int, dtype) -> np.ndarray:
    """Rows of a list column, filled up with zeros to `dims`."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims).astype(dtype)
    out = np.zeros((len(sizes), dims), dtype=dtype)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first so that squares neither overflow nor vanish."""
    rows = np.asarray(rows, dtype=np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
