"""Embedding tables, as the vector operators of this subpackage read them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(column: str) -> Column:
    """Whether a vector can be computed with: not NULL, and without NULL or non-finite entries."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.col(column).isNotNull() & ~F.exists(column, odd)


def usual_length(df: DataFrame, column: str) -> int:
    """The length that most usable vectors have (ties: the longer one); 0 without any."""
    found = (df.filter(finite(column)).groupBy(F.size(column).alias("d")).count()
             .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    return found[0]["d"] if found else 0


def usable(column: str, length: int) -> Column:
    return F.coalesce(finite(column) & (F.size(column) == length), F.lit(False))


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a column without NULLs, as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), length)
