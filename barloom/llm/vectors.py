"""Vectors as rows: which of them count, and as arrays inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import named


def usable(vector: Column) -> Column:
    """Whether a vector is not null, finite in all components and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & finite & nonzero, F.lit(False))


def as_rows(df: DataFrame, id_col: str, vector_col: str, *others: Column) -> DataFrame:
    """``vec_id``, ``vec`` (doubles) and further columns of the rows that take part."""
    vector = named(vector_col).cast("array<double>")
    rows = df.select(named(id_col).cast("long").alias("vec_id"), vector.alias("vec"), *others)
    return rows.where(usable(F.col("vec")))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that huge and tiny components are safe."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Cosine of one vector with rows; equal rows give equal values wherever they stand."""
    top = (many * one).sum(axis=1)
    return top / (np.sqrt((many * many).sum(axis=1)) * np.sqrt((one * one).sum()))
