"""Embedding columns: which rows take part, and batches of them as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_whole(vec: Column) -> Column:
    """A vector that is there and has finite entries only (an empty one has none to be wrong)."""
    value = vec.cast("array<double>")
    return vec.isNotNull() & F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))


def common_length(vectors: DataFrame, vec_col: str) -> int:
    """The length that most vectors have (of equally frequent ones the longest; 0 without rows)."""
    found = vectors.groupBy(F.size(vec_col).alias("length")).count()
    first = found.orderBy(F.desc("count"), F.desc("length")).first()
    return int(first["length"]) if first else 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
