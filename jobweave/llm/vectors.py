"""Tables of vectors: what takes part, and rows as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vectors: DataFrame, length: int | None = None, column: str = "embedding") -> DataFrame:
    """Rows whose vector can be compared: not null or zero, every component finite, of the usual length."""
    good = vectors.where(F.col(column).isNotNull() & finite(F.col(column)))
    return good.where(F.size(column) == (usual_length(vectors, column) if length is None else length))


def usual_length(vectors: DataFrame, column: str = "embedding") -> int:
    """The most frequent length of comparable vectors, of equally frequent ones the largest; 0 if there is none."""
    good = vectors.where(F.col(column).isNotNull() & finite(F.col(column)))
    usual = good.groupBy(F.size(column).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return usual["length"] if usual else 0


def finite(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a column without nulls, all of one length, as rows in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row: the same two vectors give the same number wherever they stand."""
    return np.einsum("ij,ij->i", a, b)
