"""What both vector operators need: clean vectors, one per id."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components that has any."""
    # A sum of x - x is 0 for finite components, NaN for others and null with a null.
    zero = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (x.cast("double") - x.cast("double")))
    return F.coalesce((zero == 0.0) & (F.size(vector) > 0), F.lit(False))


def one_per_id(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, embedding``: rows of one id are one vector, the smallest of them; rows
    without id are left out."""
    given = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<float>").alias("embedding"),
    ).filter("vec_id is not null")
    return given.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of equally long lists as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(-1, size)


def by_length(column: pa.Array) -> list[tuple[int, np.ndarray]]:
    """The lengths of the lists and which rows have each."""
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
    return [(int(n), np.flatnonzero(lengths == n)) for n in np.unique(lengths)]
