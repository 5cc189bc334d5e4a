"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The labelled rows are split by a hash of their id: two quarters give the lexicon, one the trees,
one the calibration, so that no part is fitted on what an earlier part has learned from. The
lexicon (words and word beginnings) is counted by Spark; trees and calibration are fitted on the
feature rows of a bounded sample. Every text is then scored whole, in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import Work, chosen, crc_remainder, let_go, read, smallest_hashes

#: Most labelled rows of each class that are learned from (those with the smallest hashes), and
#: most entries of each lexicon.
SAMPLE, LEXICON = 10_000, 3_000
THRESHOLD = 0.7
#: Letters at the beginning of a word that may be toxic whatever follows.
STEM = 5
#: Distinct words a worker remembers; results do not depend on it.
_KEPT_WORDS = 200_000
_ROWS = 256  # texts scored at a time

# Second-person words of four languages; signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie ihnen tu te toi "
    "ton ta tes vous votre vos usted ustedes tú ti vosotros vuestro vuestra tus".split()
)
_LEET = str.maketrans("0134578@$!", "oieastbasi")

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(rb"[A-Za-z]+[0-9@$*!]+[A-Za-z][A-Za-z0-9@$*!]*")
_SPACED = re.compile(rb"(?<![A-Za-z])(?:[A-Za-z][.*_-]){3,}[A-Za-z](?![A-Za-z])")
_SHOUTED = re.compile(rb"(?<![A-Za-z])[A-Z]{3,}(?![A-Za-z])")
_NOT_LETTER = re.compile(r"[^a-z]")

FEATURES = (
    "length", "word_weight", "stem_weight", "word_hits", "stem_hits", "distinct_hits", "densest",
    "near_second", "second_person", "capitals", "shouted", "digits", "exclaimed", "asked", "marks",
    "hash_star", "obfuscated", "obfuscated_hits", "spaced_hits", "mean_word", "distinct_words",
)


class Features:
    """Dense features of a text, given the lexicon's weights of words and stems."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        # Rows of the table: word weight, stem weight, hit by word, hit by stem, second person.
        self._table, self._rows = [np.zeros(5)], {}
        self._code: dict[str, int] = {}

    def __getstate__(self):
        return self.words, self.stems

    def __setstate__(self, state):
        self.__init__(*state)

    def forget(self) -> None:
        """Let the words met so far go; a worker keeps the model itself for its later tasks."""
        self._code = {}

    def _add(self, new: set[str]) -> None:
        if len(self._code) + len(new) > _KEPT_WORDS:
            self._code.clear()
        for w in new:
            a, b = self.words.get(w, 0.0), self.stems.get(w[:STEM], 0.0) if len(w) > STEM else 0.0
            row = (a, b, float(a > 0), float(b > 0), float(w in SECOND_PERSON))
            if any(row):
                if row not in self._rows:
                    self._rows[row] = len(self._table)
                    self._table.append(np.array(row))
                self._code[w] = self._rows[row]
            else:
                self._code[w] = 0

    def _known(self, piece: bytes) -> bool:
        plain = _NOT_LETTER.sub("", piece.decode("ascii").lower().translate(_LEET))
        return plain in self.words

    def __call__(self, text: str) -> list[float]:
        words = _WORD.findall(text.lower())
        raw = text.encode("utf-8", "replace")
        n, size = max(1, len(words)), max(1, len(raw))
        distinct = set(words)
        if new := distinct.difference(self._code):
            self._add(new)
            if len(self._code) < len(distinct):  # cleared while adding
                self._add(distinct)
        codes = np.fromiter(map(self._code.__getitem__, words), np.int64, len(words))
        at = np.flatnonzero(codes)
        rows = np.stack(self._table)[codes[at]] if len(at) else np.zeros((0, 5))
        hits = at[(rows[:, 2] + rows[:, 3]) > 0]
        second = at[rows[:, 4] > 0]
        near = 0
        if len(hits) and len(second):
            i = np.searchsorted(second, hits)
            left = np.abs(hits - second[np.maximum(i - 1, 0)])
            right = np.abs(second[np.minimum(i, len(second) - 1)] - hits)
            near = int((np.minimum(left, right) <= 8).sum())
        densest = 0
        if len(hits):
            densest = int((np.arange(len(hits)) - np.searchsorted(hits, hits - 100) + 1).max())
        sums = rows.sum(0)
        seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
        letters = max(1, int(seen[65:91].sum() + seen[97:123].sum()))
        mixed = _MIXED.findall(raw)
        return [
            math.log1p(len(words)), sums[0] / n, sums[1] / n, sums[2] / n, sums[3] / n,
            len({words[j] for j in hits}) / n, densest, near / n, sums[4] / n,
            seen[65:91].sum() / letters, len(_SHOUTED.findall(raw)) / n, seen[48:58].sum() / size,
            seen[33] / n, seen[63] / n, (seen[33:48].sum() + seen[58:65].sum()) / size,
            (seen[35] + seen[42] + seen[36]) / n, len(mixed) / n,
            sum(map(self._known, mixed)) / n,
            sum(map(self._known, _SPACED.findall(raw))) / n,
            sum(map(len, distinct)) / max(1, len(distinct)), len(distinct) / n,
        ]

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self(t or "") for t in texts]).reshape(len(texts), len(FEATURES))


@dataclass
class Trees:
    """Boosted regression trees on log odds; nodes of a tree in heap order."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < len(f):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += v[node - len(f)]
        return out


def fit_trees(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 120, depth: int = 4,
    rate: float = 0.1, bins: int = 48, ridge: float = 1.0, least: float = 5.0,
) -> Trees:
    """Second-order boosting of the logistic loss on quantile histograms."""
    p = float(np.clip(np.average(y, weights=w), 1e-4, 1 - 1e-4))
    start = math.log(p / (1 - p))
    raw, n, m = np.full(len(y), start), len(y), x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    inner, leaves = 2**depth - 1, 2**depth
    features, cuts, values = [], [], []
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-raw))
        g, h = w * (q - y), w * q * (1 - q)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for j in range(m):
                if not len(edges[j]):
                    continue
                k = len(edges[j]) + 1
                key = local * k + binned[:, j]
                gs = np.bincount(key, g, width * k).reshape(width, k).cumsum(1)
                hs = np.bincount(key, h, width * k).reshape(width, k).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                gain[(hs < least) | (ht - hs < least)] = 0
                at = gain[:, :-1].argmax(1)
                top = gain[np.arange(width), at]
                for i in np.flatnonzero(top > best):
                    best[i], feature[first + i], cut[first + i] = top[i], j, edges[j][at[i]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        raw = raw + value[leaf]
        features.append(feature), cuts.append(cut), values.append(value)
    return Trees(start, np.array(features), np.array(cuts), np.array(values))


def fit_isotonic(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the best non-decreasing function: (raw at a block's middle, its mean of y)."""
    blocks: list[list[float]] = []  # mean, weight, first, last
    for i in np.argsort(raw, kind="stable"):
        blocks.append([float(y[i]), float(w[i]), float(raw[i]), float(raw[i])])
        while len(blocks) > 1 and (
            blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]
        ):
            mean, weight, _, last = blocks.pop()
            b = blocks[-1]
            b[0] = (b[0] * b[1] + mean * weight) / (b[1] + weight)
            b[1], b[3] = b[1] + weight, last
    # One extra half row of either class keeps small blocks from 0 and 1.
    means = [(b[0] * b[1] + 0.25) / (b[1] + 0.5) if b[1] < 50 else b[0] for b in blocks]
    return np.array([(b[2] + b[3]) / 2 for b in blocks]), np.maximum.accumulate(means)


@dataclass
class Model:
    """Scores texts: 0 to 1, higher where the label 1 is likelier."""

    features: Features
    trees: Trees | None
    at: np.ndarray
    mean: np.ndarray
    base: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.base)
        raw = self.trees.raw(self.features.matrix(texts))
        calibrated = np.interp(raw, self.at, self.mean) if len(self.at) else 1 / (1 + np.exp(-raw))
        # The raw score orders texts within a block of equal calibrated scores.
        return np.clip(0.999 * calibrated + 0.001 / (1 + np.exp(-raw)), 0.0, 1.0)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, word, toxic, n, docs): occurrences of words and stems by class, at most 5 a text."""
    let_go()
    for batch in batches:
        found: dict[tuple[str, str, int], list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own: dict[tuple[str, str], int] = {}
            for w in _WORD.findall((text or "").lower()):
                own[("word", w)] = own.get(("word", w), 0) + 1
                if len(w) > STEM:
                    own[("stem", w[:STEM])] = own.get(("stem", w[:STEM]), 0) + 1
            own[("all", "")] = len(own)
            for (kind, w), n in own.items():
                c = found.setdefault((kind, w, toxic), [0, 0])
                c[0] += n if kind == "all" else min(n, 5)
                c[1] += 1
        rows = [(*k, *v) for k, v in found.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows, strict=True)], ["kind", "word", "toxic", "n", "docs"]
            )


def _lexicon(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Log ratios of the rates of use in toxic and other texts: words and stems that stand out."""
    by = (
        rows.select("text", "toxic").mapInArrow(_counts, "kind string, word string, toxic long, n long, docs long")
        .groupBy("kind", "word").agg(
            *(F.sum(F.when(F.col("toxic") == t, F.col(c)).otherwise(0)).alias(f"{c}{t}")
              for t in (0, 1) for c in ("n", "docs"))
        )
    ).withColumn("total", F.col("n1") + F.col("n0"))
    total = by.where("kind = 'all'").select("n1", "n0").head()
    if total is None or not total["n1"] or not total["n0"]:
        return {}, {}
    n1, n0 = total["n1"], total["n0"]
    ratio = F.log((F.col("n1") + 0.5) / n1) - F.log((F.col("n0") + 0.5) / n0)
    out = []
    for kind in ("word", "stem"):
        top = (
            by.where((F.col("kind") == kind) & (F.col("docs1") >= 4))
            .withColumn("weight", ratio).where("weight > 1.2")
            .orderBy(F.desc(F.col("weight") * F.sqrt("docs1")), "word").limit(LEXICON)
            .select("word", "weight").collect()
        )
        out.append({r["word"]: r["weight"] for r in top})
    return out[0], out[1]


def _feature_rows(features: Features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features.matrix(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1), batch.column(2), batch.column(3)],
                ["x", "toxic", "part", "weight"],
            )

    return run


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows whose crc32(doc_id as text) mod 3 is not 1.

    An id with several labels is toxic if one of them says so; null ids and labels teach nothing.
    Without rows of both classes every score is the share of toxic rows (0 without any).
    """
    spark = documents.sparkSession
    known = (
        chosen(labels, doc_id="long", toxic="long").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(crc_remainder("doc_id", 3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    classes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    base = classes.get(1, 0) / max(1, sum(classes.values()))
    nothing = Model(Features({}, {}), None, np.empty(0), np.empty(0), base)
    if len(classes) < 2:
        return nothing
    sample = None
    for t, n in classes.items():
        part = known.where(F.col("toxic") == t).withColumn("weight", F.lit(max(1.0, n / SAMPLE)))
        part = smallest_hashes(part, "doc_id", "toxicity", SAMPLE) if n > SAMPLE else part
        sample = part if sample is None else sample.union(part)
    with Work(spark, "toxicity") as work:
        # At most 2 * SAMPLE ids: small enough to send to every task.
        ids = F.broadcast(work.write(sample))
        rows = work.write(
            chosen(documents, doc_id="long", text="string").join(ids, "doc_id")
            .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)))
            .dropDuplicates(["doc_id"])
        )
        words, stems = _lexicon(rows.where("part < 2"))
        features = Features(words, stems)
        got = (
            rows.where("part >= 2").select("text", "toxic", "part", "weight")
            .mapInArrow(_feature_rows(features), "x array<double>, toxic long, part long, weight double")
            .toPandas()
        )
    fitted, held = got[got["part"] == 2], got[got["part"] == 3]
    if fitted["toxic"].nunique() < 2:
        return nothing
    grid = lambda part: np.array(part["x"].tolist()).reshape(len(part), len(FEATURES))
    trees = fit_trees(grid(fitted), fitted["toxic"].to_numpy(float), fitted["weight"].to_numpy(float))
    at = mean = np.empty(0)
    if held["toxic"].nunique() == 2:
        at, mean = fit_isotonic(
            trees.raw(grid(held)), held["toxic"].to_numpy(float), held["weight"].to_numpy(float)
        )
    return Model(features, trees, at, mean, base)


def _scored(model, at: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        m = model.value
        for batch in batches:
            # Results leave in small batches, so that a task holds its texts once.
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                score = m.score(part.column(at).to_pylist())
                names = [n for i, n in enumerate(part.schema.names) if keep or i != at]
                columns = [c for i, c in enumerate(part.columns) if keep or i != at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                    [*names, "score", "predicted"],
                )
        m.features.forget()
        pa.default_memory_pool().release_unused()

    return run


def score_texts(frame: DataFrame, model: Model, text: str = "text", keep: bool = False) -> DataFrame:
    """The frame's other columns with score and predicted; ``text`` is read, and goes unless kept."""
    sent = frame.sparkSession.sparkContext.broadcast(model)  # two lexicons and some trees
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema if keep or f.name != text)
    run = _scored(sent, frame.columns.index(text), keep)
    return frame.mapInArrow(run, f"{fields}score double, predicted int")


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its score and whether it reaches the threshold.

    Null texts are empty, and empty ones are scored like any other; repeated rows get a row each;
    a null doc_id stays null and is not held out;
    an empty table gives no rows; further columns are ignored.
    """
    docs = chosen(documents, doc_id="long", text="string")
    return score_texts(docs, fit(documents, labels)).select(
        "doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
