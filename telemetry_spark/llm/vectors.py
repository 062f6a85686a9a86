"""Vector columns: what can be computed with, and Arrow lists as NumPy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def finite(vector: str, below: float | None = None) -> str:
    """SQL: a vector that is not null and holds no null or non-finite entry, nor one whose absolute
    value reaches ``below``."""
    limit = f"{below!r}D" if below else "double('inf')"
    return f"({vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < {limit}))"


def matrix(column: pa.Array | pa.ChunkedArray, width: int, dtype=float) -> np.ndarray:
    """The lists of ``column`` (none null, none longer than ``width``) as rows, short ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), dtype)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The rows of a matrix as Arrow lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel(), kind))
