"""Exact top-k search by inner product without random access.

A block of rows is one list per component, sorted by value. For a query the lists are read from
the end that its component favours, to a growing depth; what has been read gives each row a
lower and an upper bound of its score, the list's ends standing in for what has not. Rows whose
upper bound is below the k-th lower bound can't qualify, and neither can a row that no list has
shown once the sum of the frontiers is below it. Reading goes on for the rows that are left; at the
lists' ends both bounds of a row are its score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.cells import best, search, valid_vectors
from cabmill.llm.common import Work, read, ship
from cabmill.llm.integer_scores import EXACT, inner, integers, lengths, usable

#: Depths as shares of a list; the last one is its end.
DEPTHS = (0.25, 0.5, 0.75, 0.875, 0.9375, 1.0)


class SortedLists:
    """The components of some rows as sorted lists."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, order, 0)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(len(rows))[:, None], 0)

    def bounds(self, queries: np.ndarray, depth: int, live=slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the live rows' scores for every query, lists read to a depth."""
        n, rows, place = len(self.rows), self.rows[live], self.place[live]
        up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
        low = high = 0.0
        for part, seen, frontier, end in (
            (up, place >= n - depth, self.values[n - depth], self.values[0]),
            (down, place < depth, self.values[depth - 1], self.values[-1]),
        ):
            known = part @ np.where(seen, rows, 0.0).T
            unseen = (~seen).astype(float).T
            high = high + known + (part * frontier) @ unseen
            low = low + known + (part * end) @ unseen
        return low, high


def top_by_bounds(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    lists, n = SortedLists(rows), len(rows)
    alive = ids[None, :] != query_ids[:, None]
    live, score = np.arange(n), np.empty((len(queries), n))
    for share in DEPTHS:
        depth = max(1, int(n * share))
        low, high = lists.bounds(queries, depth, live)
        score = np.where(alive, low, -np.inf)
        if len(live) > k:
            kth = np.partition(score, len(live) - k, axis=1)[:, len(live) - k]
            alive &= high >= kth[:, None]
            left = alive.any(0)
            live, alive, score = live[left], alive[:, left], score[:, left]
    out = []
    for i in range(len(queries)):
        own = live[alive[i]]
        exact = score[i, alive[i]]
        for j in best(exact, ids[own], k):
            out.append((int(query_ids[i]), int(ids[own[j]]), int(exact[j])))
    return out


def top_scores(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """The k best of each query, and more where rows or queries are too long for doubles to hold
    their scores exactly: such pairs are scored one by one, in whole numbers."""
    row_lengths, query_lengths = lengths(rows), lengths(queries)
    short, plain = row_lengths < EXACT**0.5, query_lengths < EXACT**0.5
    out: list[tuple[int, int, int]] = []
    if short.any() and plain.any():
        out = top_by_bounds(ids[short], rows[short], query_ids[plain], queries[plain], k)
    for i in range(len(queries)):
        some = np.flatnonzero((~short if plain[i] else np.ones(len(ids), bool)) & (ids != query_ids[i]))
        if len(some):
            score = inner(rows[some], row_lengths[some], queries[i], float(query_lengths[i]))
            at = some[np.lexsort((ids[some], ~score))[:k]]
            scored = dict(zip(some.tolist(), score.tolist(), strict=True))
            out += [(int(query_ids[i]), int(ids[j]), scored[j]) for j in at.tolist()]
    return out


def exact_topk(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k rows with the highest integer inner product for each query, ties to the smaller id.

    Components become floor(256 x); a score beyond 64 bits counts as the nearest long. Queries are the rows whose vec_id is divisible by ``every``,
    candidates all rows but the query's own (fewer than k give fewer). Null, empty and non-finite
    vectors and null ids take no part, an id counts once (its smallest vector), vectors meet only
    those of their own length; an empty table gives no rows; further columns are ignored.
    """
    ship(vectors.sparkSession)
    valid = valid_vectors(vectors).where(usable("v"))
    searcher = lambda ids, rows, query_ids, queries: top_scores(
        ids, integers(rows), query_ids, integers(queries), k
    )
    with Work(vectors.sparkSession, "topk") as work:
        return search(work, valid, F.col("vec_id") % every == 0, searcher, k, "long")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(read(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
