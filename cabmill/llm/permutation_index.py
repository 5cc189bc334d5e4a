"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Every row is posted in the inverted files
of its pivots with the pivot's place. A query reads the files of its own pivots; the shared
pivots' places give the footrule distance of the two permutations (a pivot that is missing counts
as one place behind the last). The rows nearest by footrule are ranked again by exact cosine, and
besides their share all rows whose permutation is almost the query's: footrule says little about
the order of near copies.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.cells import best, search, valid_vectors
from cabmill.llm.common import Work, read, smallest_hashes

#: Pivots (of a bounded sample, the rows with the smallest hashes), how many of them represent a
#: vector, and the share of a block's rows that is ranked again. More of any of them finds more.
PIVOTS, NEAREST, SHARE = 256, 48, 0.25
#: A row is almost the query when its nearness is this part of the highest one possible.
ALIKE = 0.7
#: Sample rows for each pivot, and the cosines that pivots stay below, so that a cluster of near
#: copies does not take its share of them: the next one counts if the one before leaves fewer than half.
SAMPLED, APART = 8, (0.7, 0.8, 0.9, 0.97)


class PermutationIndex:
    """Inverted files of the pivots over some rows."""

    def __init__(self, pivots: np.ndarray, rows: np.ndarray, nearest: int):
        self.pivots, self.nearest = pivots, min(nearest, len(pivots))
        order = self.permutation(rows)
        file = order.ravel()
        row = np.repeat(np.arange(len(rows)), self.nearest)
        weight = np.tile(np.arange(self.nearest, 0, -1), len(rows))
        by_file = np.argsort(file, kind="stable")
        cuts = np.searchsorted(file[by_file], np.arange(len(pivots) + 1))
        self.files = [
            (row[by_file[a:b]], weight[by_file[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        self.size = len(rows)

    def permutation(self, rows: np.ndarray) -> np.ndarray:
        """Numbers of the nearest pivots of unit vectors, nearest first, ties to the smaller."""
        return np.argsort(-(rows @ self.pivots.T), axis=1, kind="stable")[:, : self.nearest]

    def nearness(self, permutation: np.ndarray) -> np.ndarray:
        """Per row half of what its footrule distance is below that of strangers: with places
        counted from the end, a shared pivot takes off twice the smaller of its two places."""
        out = np.zeros(self.size, np.int64)
        for place, pivot in enumerate(permutation.tolist()):
            row, weight = self.files[pivot]
            out[row] += np.minimum(weight, self.nearest - place)
        return out


def _searcher(pivots: np.ndarray, k: int, nearest: int, share: float):
    def run(ids, rows, query_ids, queries):
        lengths, query_lengths = np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1)
        own = pivots[[len(p) == rows.shape[1] for p in pivots]] if pivots.dtype == object else pivots
        if not len(own) or len(own[0]) != rows.shape[1]:
            own = rows[:1] / lengths[:1, None]
        index = PermutationIndex(np.asarray(own.tolist()), rows / lengths[:, None], nearest)
        permutations = index.permutation(queries / query_lengths[:, None])
        n = len(ids)
        ranked = min(n, int(np.ceil(share * n)) + k + 1)
        out = []
        for i, q in enumerate(queries):
            # Of rows with equal distances those with smaller ids come first.
            nearness = index.nearness(permutations[i])
            key = nearness * n - np.arange(n)
            some = ranked + int((nearness >= ALIKE * index.nearest * (index.nearest + 1) / 2).sum())
            near = np.argpartition(-key, some - 1)[:some] if some < n else np.arange(n)
            near = np.sort(near[ids[near] != query_ids[i]])
            score = (rows[near] @ q) / (lengths[near] * query_lengths[i])
            for j in best(score, ids[near], k):
                out.append((int(query_ids[i]), int(ids[near[j]]), float(score[j])))
        return out

    return run


def _apart(units: np.ndarray, count: int) -> list[int]:
    """Places of units no two of which are closer than need be, the first ones first."""
    cosine, out = units @ units.T, []
    for limit in (*APART, np.inf):
        out, free = [], np.ones(len(units), bool)
        while free.any() and len(out) < count:
            out.append(int(free.argmax()))
            free &= cosine[out[-1]] < limit
            free[out[-1]] = False
        if len(out) >= min(count, len(units)) / 2:
            break
    return out


def _pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """Distinct vectors scaled to length one: of those whose ids have the smallest hashes, ones
    that lie apart. Vectors of different lengths share the count by their numbers."""
    rows = smallest_hashes(vectors, "vec_id", "pivot", SAMPLED * count).collect()
    distinct = list(dict.fromkeys(tuple(r["v"]) for r in rows))
    of_length: dict[int, list[np.ndarray]] = {}
    for p in distinct:
        of_length.setdefault(len(p), []).append(np.array(p) / np.linalg.norm(p))
    units = []
    for some in of_length.values():
        own = max(1, round(count * len(some) / len(distinct)))
        units += [some[i] for i in _apart(np.array(some), own)]
    if len(of_length) > 1:
        out = np.empty(len(units), object)
        out[:] = units
        return out
    return np.array(units)


def permutation_search(
    vectors: DataFrame, k: int = 5, every: int = 50, pivots: int = PIVOTS, nearest: int = NEAREST,
    share: float = SHARE,
) -> DataFrame:
    """The k rows with the largest cosine found for each query, ties to the smaller id.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but the
    query's own (fewer than k give fewer). Null, empty, zero and non-finite vectors and null ids
    take no part, an id counts once (its smallest vector), vectors meet only those of their own
    length; an empty table gives no rows; further columns are ignored.
    """
    valid = valid_vectors(vectors).where(F.exists("v", lambda x: x != 0))
    with Work(vectors.sparkSession, "permutation") as work:
        valid = work.write(valid)
        searcher = _searcher(_pivots(valid, pivots), k, nearest, share)
        return search(work, valid, F.col("vec_id") % every == 0, searcher, k, "double")


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_search(read(spark, sf_dir, "embeddings"))
