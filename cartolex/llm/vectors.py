"""Vectors in columns: which take part, how they are read, and cosines that repeat to the last bit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null or empty, has only finite components, and is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def dimension(df: DataFrame, vector: str) -> int:
    """The most frequent length of the usable vectors (the greater of equals); 0 without any."""
    found = df.where(usable(F.col(vector))).groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else 0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by way of their largest component so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of unit rows, pair by pair; equal vectors give equal results wherever they stand."""
    return (a * b).sum(1)
