"""Rows with integer vectors, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """``rows`` with column ``v``, their vector's components as
    floor(scale * x), x as double; rows whose vector is null or holds null or
    non-finite components are dropped."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("v").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn(
        "v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def shape(rows: DataFrame) -> tuple[int, int, int]:
    """(number of rows, longest vector, largest absolute component); raises
    when inner products or squared distances might not fit 64 bits."""
    size: Column = F.max(F.size("v"))
    top = F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x))))
    n, longest, largest = (x or 0 for x in rows.agg(F.count("*"), size, top).first())
    if longest * (2 * largest) ** 2 >= 1 << 62:
        raise ValueError(f"a vector component of {largest} after scaling is too large for exact 64-bit scores")
    return n, longest, largest


def matrix(vectors, dim: int) -> np.ndarray:
    """Vectors as rows of int64, the shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out
