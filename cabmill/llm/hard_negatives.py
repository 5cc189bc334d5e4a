"""Hard negatives by angular triangle filtering.

Every row stores its angles to some reference directions. The angles of an anchor and of a row to
one direction bound the angle between the two (the triangle inequality on the sphere): its cosine
lies in cos(a)cos(r) -+ sin(a)sin(r). Multiplied by both lengths and widened by more than all
rounding, that is an interval of scores. Positives: only rows whose interval reaches what the best
seeds score are scored. Negatives: only rows whose interval overlaps an anchor's score windows, and
the part of them that can still be among the first.

Rows and anchors meet in cells of one block of each, dealt by a hash of the id within a label
(positives) or over all labels (negatives), so a label that holds most rows burdens no task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabmill.llm.common import Work, read, ship, smallest_hashes
from cabmill.llm.integer_scores import first_rows, inner, integers, lengths, matrix

#: Reference directions, how many of them (those that bound an anchor best) are used per anchor,
#: and sample rows they are chosen from, for each.
REFERENCES, USED, SAMPLED = 16, 4, 16
#: Bytes of the vectors of a block of rows, and of anchors; least rows of a block.
ROW_BYTES, ANCHOR_BYTES, LEAST_ROWS = 16 << 20, 4 << 20, 1024
#: Rows scored first, whose scores tell which intervals are too low.
SEEDS = 64


def spread(units: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` of some unit vectors: the first, then each time the one whose largest
    cosine (of either sign) with those chosen is the smallest."""
    if not len(units):
        return units
    chosen, near = [0], np.abs(units @ units[0])
    while len(chosen) < min(count, len(units)):
        near[chosen[-1]] = 2.0
        at = int(near.argmin())
        if near[at] > 1 - 1e-9:
            break
        chosen.append(at)
        near = np.maximum(near, np.abs(units @ units[at]))
    return units[chosen]


def _scaled(z: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows of length one; a row of zeros stays."""
    most = np.abs(z).max(1, initial=0.0)
    small = z / np.where(most > 0, most, 1.0)[:, None]
    size = np.linalg.norm(small, axis=1)
    return small / np.where(size > 0, size, 1.0)[:, None]


def references(rows: DataFrame, count: int = REFERENCES) -> dict[int, np.ndarray]:
    """Directions for every length of vectors, from a sample of bounded size that is spread."""
    sample = smallest_hashes(rows, "vec_id", "reference", SAMPLED * count).select("v").collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r.v), []).append(r.v)
    out = {}
    for dim, some in by_dim.items():
        z = integers(np.array(some))
        z = z[z.any(1)]
        out[dim] = spread(_scaled(z, lengths(z)), count)
    return out


def angles(z: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """Angles of rows to directions; without any direction, one right angle, which bounds nothing
    (as does a row of zeros: its score is zero whatever its angle)."""
    if directions is None or not len(directions):
        return np.full((len(z), 1), np.pi / 2)
    return np.arccos(np.clip(_scaled(z, lengths(z)) @ directions.T, -1.0, 1.0))


def slack(dim: int) -> float:
    """More than the cosine of an angle can be wrong by: an angle comes from a rounded cosine, and
    near a pole its error is the root of that rounding."""
    return 8 * math.sqrt(dim * np.finfo(float).eps)


class Stored:
    """Rows with their lengths and stored angles, and score bounds for an anchor."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, z: np.ndarray, angle: np.ndarray):
        self.ids, self.labels, self.z, self.lengths = ids, labels, z, lengths(z)
        self.cos, self.sin = np.cos(angle).T.copy(), np.sin(angle).T.copy()

    def bounds(self, anchors: "Stored", i: int) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score that each row can have with anchor i."""
        low, high = np.full(len(self.ids), -1.0), np.full(len(self.ids), 1.0)
        for j in np.argsort(anchors.sin[:, i], kind="stable")[:USED]:
            middle = anchors.cos[j, i] * self.cos[j]
            half = anchors.sin[j, i] * self.sin[j]
            np.maximum(low, middle - half, out=low)
            np.minimum(high, middle + half, out=high)
        wide = slack(self.z.shape[1])
        with np.errstate(over="ignore", invalid="ignore"):
            size = self.lengths * anchors.lengths[i]
            low, high = np.floor(size * (low - wide)) - 1, np.ceil(size * (high + wide)) + 1
        # Scores as large as this are not held by doubles: no bound.
        huge = ~(size < 1 << 52)
        low[huge], high[huge] = -np.inf, np.inf
        return low, high

    def scores(self, at: np.ndarray, anchors: "Stored", i: int) -> np.ndarray:
        return inner(self.z[at], self.lengths[at], anchors.z[i], float(anchors.lengths[i]))


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], ~scores[at]))][:k]  # ~x = -x - 1, for the least long too


def _seeds(middle: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Places of the live rows with the highest middles of their intervals."""
    if len(live) <= SEEDS:
        return live
    return live[np.argpartition(-middle[live], SEEDS - 1)[:SEEDS]]


def _middles(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.where(np.isinf(high), high, np.where(np.isinf(low), 0.0, low) + high)


def positives_in(rows: Stored, anchors: Stored, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per anchor: ids and scores of its k best rows of a block, all of its label."""
    for i, own in enumerate(anchors.ids.tolist()):
        live = np.flatnonzero(rows.ids != own)
        low, high = rows.bounds(anchors, i)
        seeds = _seeds(_middles(low, high), live)
        if len(seeds) >= k:
            scored = rows.scores(seeds, anchors, i)
            live = live[high[live] >= np.partition(scored, len(scored) - k)[len(scored) - k]]
        score = rows.scores(live, anchors, i)
        best = first(score, rows.ids[live], k)
        yield own, rows.ids[live[best]], score[best]


def windows(scores: list[int], low: int, high: int) -> list[tuple[int, int]]:
    """For each positive's score the least and the most that a negative's may be."""
    return [(-(-low * s // 100), high * s // 100) for s in scores]


def negatives_in(
    rows: Stored, anchors: Stored, held: list[list[tuple[int, int]]], k: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per anchor and score window: the window's number, ids and scores of the k best rows of
    another label in it."""
    for i, spans in enumerate(held):
        spans = [(n, a, b) for n, (a, b) in enumerate(spans) if a <= b]
        if not spans:
            continue
        low, high = rows.bounds(anchors, i)
        other = rows.labels != anchors.labels[i]
        overlaps = [other & (high >= a) & (low <= b) for _, a, b in spans]
        seeds = _seeds(_middles(low, high), np.flatnonzero(np.logical_or.reduce(overlaps)))
        scored = rows.scores(seeds, anchors, i)
        wanted = np.zeros(len(rows.ids), bool)
        for (_, a, b), overlap in zip(spans, overlaps, strict=True):
            inside = scored[(scored >= a) & (scored <= b)]
            if len(inside) >= k:  # rows that can't reach the k-th of these are too low
                overlap = overlap & (high >= np.partition(inside, len(inside) - k)[len(inside) - k])
            wanted |= overlap
        at = np.flatnonzero(wanted)
        score = rows.scores(at, anchors, i)
        for n, a, b in spans:
            fits = np.flatnonzero((score >= a) & (score <= b))
            best = fits[first(score[fits], rows.ids[at[fits]], k)]
            if len(best):
                yield i, n, rows.ids[at[best]], score[best]


def _with_angles(directions: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("v"))
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            first_at = np.cumsum(sizes) - sizes
            found: list = [None] * batch.num_rows
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                z = integers(flat[first_at[own][:, None] + np.arange(dim)[None]])
                for i, a in zip(own.tolist(), angles(z, directions.get(dim)), strict=True):
                    found[i] = a
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.float64()))], [*batch.schema.names, "angles"]
            )

    return run


def _stored(table: pa.Table, dim: int) -> Stored:
    n = table.num_rows
    angle = matrix(table.column("angles"), 1).reshape(n, -1) if n else np.empty((0, 1))
    return Stored(
        table.column("vec_id").to_numpy(), table.column("label").to_numpy(),
        integers(matrix(table.column("v"), dim)), angle,
    )


def _in_cells(
    work: Work, rows: DataFrame, anchors: DataFrame, group: list[str], run: Callable, schema: str, spread_over: int
) -> DataFrame:
    """``run(rows, anchors)`` on every cell of a block of rows and a block of anchors of a group.

    A row is sent once per block of anchors, an anchor once per block of rows; blocks are as large
    as their bytes allow, so few copies are made, and smaller where the table is small, so that
    all tasks have work.
    """
    sizes = rows.groupBy(*group).agg(F.count("*").alias("n"), F.sum(F.col("is_anchor").cast("long")).alias("m"))
    per_block = lambda bytes_: F.greatest(F.lit(1), F.floor(F.lit(bytes_) / (F.col("dim") * 8)))
    by_size = F.ceil(F.col("n") / per_block(ROW_BYTES))
    by_tasks = F.least(F.lit(spread_over), F.ceil(F.col("n") / LEAST_ROWS))
    # Written, so its size is known: while small it is broadcast, and no group meets in one task.
    sizes = work.write(sizes.where("m > 0").select(
        *group, F.greatest(by_size, by_tasks).cast("int").alias("row_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("m") / per_block(ANCHOR_BYTES))).cast("int").alias("anchor_blocks"),
    ))
    dealt = lambda blocks, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    cell = [*group, "rb", "ab"]
    left = rows.join(sizes, group).withColumn("rb", dealt("row_blocks", "row"))
    left = left.withColumn("ab", every("anchor_blocks")).drop("row_blocks", "anchor_blocks", "is_anchor")
    right = anchors.join(sizes, group).withColumn("ab", dealt("anchor_blocks", "anchor"))
    right = right.withColumn("rb", every("row_blocks")).drop("row_blocks", "anchor_blocks", "is_anchor")
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(run, schema)


def _positive_cells(k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        anchor, row, score = [], [], []
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            for own, ids, found in positives_in(_stored(left, dim), _stored(right, dim), k):
                anchor += [own] * len(ids)
                row += ids.tolist()
                score += found.tolist()
        return pa.table({
            "anchor_id": pa.array(anchor, pa.int64()), "positive_id": pa.array(row, pa.int64()),
            "positive_score": pa.array(score, pa.int64()),
        })

    return run


def _negative_cells(k: int, low: int, high: int):
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            rows, anchors = _stored(left, dim), _stored(right, dim)
            positives = right.column("positives").to_pylist()
            held = [windows([p["positive_score"] for p in own], low, high) for own in positives]
            for i, n, ids, scores in negatives_in(rows, anchors, held, k):
                own, p = int(anchors.ids[i]), positives[i][n]
                out += [
                    (own, p["positive_id"], p["positive_score"], a, s)
                    for a, s in zip(ids.tolist(), scores.tolist(), strict=True)
                ]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return run


def _ranked(found: DataFrame, by: list[str], score: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    every: int = 100,
) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its ``positives`` best other
    rows of its label, the ``negatives`` best rows of another label whose score is at least
    ``low`` and at most ``high`` hundredths of the positive's.

    Scores are integer inner products of floor(256 x); higher ones come first, ties by the smaller
    vec_id; fewer rows give fewer. A negative positive's window is empty, a zero one's holds zero.
    Null labels, null, empty and non-finite vectors and null ids take no part; an id counts once
    (its smallest vector, then label); vectors meet only those of their own length; vectors of
    zeros score zero. A score beyond 64 bits counts as the nearest long. An empty table gives no
    rows; further columns are ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    tasks = 2 * spark.sparkContext.defaultParallelism
    with Work(spark, "negatives") as work:
        valid = work.write(first_rows(vectors, label="long"))
        valid = valid.select(
            F.size("v").alias("dim"), "label", "vec_id", "v", (F.col("vec_id") % every == 0).alias("is_anchor")
        )
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in valid.schema)}, angles array<double>"
        rows = work.write(valid.mapInArrow(_with_angles(references(valid)), schema))
        anchors = work.write(rows.where("is_anchor"))
        near = _in_cells(
            work, rows, anchors, ["dim", "label"], _positive_cells(positives),
            "anchor_id long, positive_id long, positive_score long", tasks,
        )
        near = _ranked(near, ["anchor_id"], "positive_score", "positive_id", positives)
        near = near.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
            F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
        )
        held = work.write(anchors.join(near, "vec_id"))
        found = _in_cells(
            work, rows, held, ["dim"], _negative_cells(negatives, low, high),
            "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
            tasks,
        )
        found = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
        return work.write(
            found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
            keep=True,
        )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(vectors.withColumn("label", moved))


ORACLE = """
WITH t AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS vec_id,
  CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM t a JOIN t r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""
