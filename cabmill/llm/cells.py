"""Searches of a query set against all vectors, in cells of one query block and one row block.

Rows and queries are dealt evenly over blocks whatever their values, so a common vector burdens
no task. A cell holds a bounded number of rows; it returns its best candidates per query, and
these few meet again by query.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabmill.llm.common import Work

#: Rows and queries of a block. Two blocks and a score for each of their pairs fit in a task.
ROWS, QUERIES = 2048, 512

Searcher = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[int, int, float]]]


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v) with v in double precision, one row per id: vectors that are null or hold null
    or non-finite components, and rows without an id, take no part; of several rows with one id
    the smallest vector counts."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate(
        [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    ).reshape(-1, dim)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ids ascend."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.argsort(-score[at], kind="stable")][:k]


def search(
    work: Work, vectors: DataFrame, is_query: Column, searcher: Searcher, k: int, score_type: str,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of what the searcher finds in all cells.

    ``searcher(ids, rows, query_ids, queries)`` gets the rows by ascending id and gives
    (query_id, vec_id, score). Vectors of different lengths never meet.
    """
    table = work.write(vectors.withColumn("is_query", is_query), keep=True)
    n, n_queries = (
        table.agg(F.count("*").alias("n"), F.count(F.when(F.col("is_query"), 1)).alias("q")).first()
    )
    row_blocks, query_blocks = max(1, math.ceil(n / ROWS)), max(1, math.ceil(n_queries / QUERIES))
    dealt = lambda blocks: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = table.select(F.size("v").alias("dim"), dealt(row_blocks).alias("rb"), "vec_id", "v")
    rows = rows.select("dim", "rb", every(query_blocks).alias("qb"), "vec_id", "v")
    queries = table.where("is_query").select(
        F.size("v").alias("dim"), dealt(query_blocks).alias("qb"), "vec_id", "v"
    )
    queries = queries.select("dim", "qb", every(row_blocks).alias("rb"), "vec_id", "v")
    cell = ["dim", "rb", "qb"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            ids = left.column("vec_id").to_numpy()
            order = np.argsort(ids)
            found = searcher(
                ids[order], _matrix(left.column("v"), dim)[order],
                right.column("vec_id").to_numpy(), _matrix(right.column("v"), dim),
            )
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        kind = pa.float64() if score_type == "double" else pa.int64()
        return pa.table({
            "query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
            "score": pa.array(columns[2], kind),
        })

    found = (
        rows.groupBy(*cell).cogroup(queries.groupBy(*cell))
        .applyInArrow(run, f"query_id long, vec_id long, score {score_type}")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
