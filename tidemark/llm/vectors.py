"""Vectors as rows: validity, classes of equal vectors, arrays from Arrow."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_usable(vec: Column) -> Column:
    """Not null or empty, all components finite, and not all zero."""
    v = vec.cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def packed(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A matrix of doubles from a column of lists of equal length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    n = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def bounded_sample(vectors: DataFrame, n: int, at_most: int, column: str = "v") -> np.ndarray:
    """About ``at_most`` of the ``n`` vectors, chosen by their hash."""
    some = vectors.where(F.pmod(F.xxhash64(column), F.lit(max(1, n))) < at_most).select(column).toArrow()[column]
    return packed(some)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Centroids of ``x``; fewer than ``k`` if it has fewer distinct rows."""
    x = np.unique(x, axis=0)
    k = max(1, min(k, len(x)))
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T * -2 + (c * c).sum(axis=1)).argmin(axis=1)
        order = np.argsort(near, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(near[order]) > 0])
        c[near[order][at]] = np.add.reduceat(x[order], at, axis=0) / np.diff(np.r_[at, len(x)])[:, None]
    return c
