"""Rows with whole vectors, and Arrow batches of them as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_whole(vector: Column) -> Column:
    """True if the vector and all its entries are there and finite."""
    broken = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~broken


def as_matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as rows of doubles; vectors of different lengths are an error."""
    sizes = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()[:5]}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), int(sizes[0]) if len(sizes) else 0)


def whole_numbers(matrix: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * entry) as long; an entry too large for that is an error."""
    scaled = np.floor(scale * matrix)
    if scaled.size and np.abs(scaled).max() >= 2.0**62:
        raise OverflowError("an entry is too large to be a long")
    return scaled.astype(np.int64)


def length_of(rows: DataFrame, vector_col: str) -> int:
    """The longest vector's length; 0 without rows."""
    return rows.agg(F.max(F.size(vector_col))).first()[0] or 0
