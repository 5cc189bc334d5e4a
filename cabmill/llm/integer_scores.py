"""Integer vectors and their exact inner products."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Below this product of two lengths doubles hold the inner product, every part of it (by Cauchy's
#: inequality none is larger) and its sums in any order.
EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def usable(v: str) -> Column:
    """Whether an array of doubles has a component, and all are finite, 256 times as large too."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * 256) == float("inf")))
    return F.col(v).isNotNull() & (F.size(v) > 0) & ~bad


def integers(v: np.ndarray) -> np.ndarray:
    """floor(256 x) of every component, a whole number as a double."""
    return np.floor(256.0 * v)


def lengths(z: np.ndarray) -> np.ndarray:
    """Euclidean lengths of rows, a little too long rather than too short."""
    most = np.abs(z).max(1, initial=0.0)
    scale = np.where(most > 0, most, 1.0)
    with np.errstate(over="ignore"):
        return most * np.sqrt(((z / scale[:, None]) ** 2).sum(1)) * (1 + 1e-12)


def inner(rows: np.ndarray, row_lengths: np.ndarray, query: np.ndarray, query_length: float) -> np.ndarray:
    """Integer inner products of rows with a query; one beyond 64 bits is the nearest long."""
    with np.errstate(over="ignore", invalid="ignore"):
        safe = row_lengths * query_length < EXACT
    if safe.all():
        return (rows @ query).astype(np.int64)
    out = np.empty(len(rows), np.int64)
    out[safe] = (rows[safe] @ query).astype(np.int64)
    own = list(map(int, query.tolist()))
    for i in np.flatnonzero(~safe).tolist():
        exact = sum(x * y for x, y in zip(map(int, rows[i].tolist()), own, strict=True))
        out[i] = min(max(exact, LEAST), MOST)
    return out


def matrix(column, dim: int) -> np.ndarray:
    """A list column of an Arrow table, whose lists all have the same length, as rows."""
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate([*parts, np.empty(0)]).reshape(-1, dim)


def first_rows(table: DataFrame, **kept: str) -> DataFrame:
    """(vec_id, v, ...) with v in double precision, one row per id: of several rows with one id
    the one with the smallest vector, then the smallest of the other columns, in order."""
    v = F.transform("embedding", lambda x: x.cast("double")).alias("v")
    columns = [F.col(f"`{c}`").cast(t).alias(c) for c, t in kept.items()]
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v, *columns)
    rows = rows.where(F.col("vec_id").isNotNull() & usable("v"))
    for c in kept:
        rows = rows.where(F.col(c).isNotNull())
    return (
        rows.groupBy("vec_id").agg(F.min(F.struct("v", *kept)).alias("row")).select("vec_id", "row.*")
    )
