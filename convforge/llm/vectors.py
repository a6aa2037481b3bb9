"""Integer vectors of an embeddings table, for the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A component's size at most; beyond it integer inner products leave 64 bits.
MAX_COMPONENT = 1 << 27


def usable(vector: str) -> Column:
    """The vector is there and all its components are finite numbers."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))


def scaled(vector: str, scale: int) -> Column:
    """floor(scale * component) of every component, exact in doubles."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))


def matrix(column, dims: int) -> np.ndarray:
    """An Arrow column of number lists as rows of ``dims`` int64 (shorter ones end in zeros)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(column.value_lengths()).astype(np.int64)
    values = np.asarray(column.flatten()).astype(np.int64)
    if len(values) and np.abs(values).max() > MAX_COMPONENT:
        raise ValueError(f"a scaled component is beyond {MAX_COMPONENT}")
    if len(size) and (size == dims).all():
        return values.reshape(len(size), dims)
    out = np.zeros((len(size), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def per_dimension(vectors: DataFrame, x: str, *aggregates) -> list:
    """One row per dimension (``dim`` from 0): the aggregates of the column ``c``."""
    return (vectors.select(F.posexplode(x).alias("dim", "c")).groupBy("dim").agg(*aggregates)
            .orderBy("dim").collect())
