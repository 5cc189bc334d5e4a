"""Ranked lexical search over trees of documents' term vectors.

A document is restricted to the terms of the items; its terms, the most frequent first, are a path
of a trie, so documents share the beginnings of their paths. A node knows, over all documents below
it, the highest count of its term and the smallest length norm m: together an upper bound of what
the term adds to a score there. An item sees only the nodes of its own terms. What they add at
most, summed down every branch, orders a depth-first search and cuts the branches that can't reach
the k-th best score so far; documents of the nodes left are scored exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabmill.llm.common import Work, chosen, collected, read, ship

#: Terms of the items of a block, which every task knows; more items are searched in more passes.
BLOCK_TERMS = 200_000
#: Entries of the documents' vectors in a tree, and bytes of a text that are split at a time.
TREE_ENTRIES, PART = 1 << 20, 1 << 20
_FOLDED = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def _parts(text: bytes) -> Iterator[bytes]:
    """The terms of a text, parted by spaces, in pieces of bounded size."""
    text, at = text.translate(_FOLDED), 0
    while at < len(text):
        end = text.find(b" ", at + PART) if len(text) - at > PART else -1
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [set().union(*(p.split() for p in _parts(t or b""))) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([sorted(s) for s in sets], pa.list_(pa.binary()))], ["item_id", "terms"]
        )


def _vectors(vocabulary: dict[bytes, int]):
    """Per document with any term: the number of its terms, and counts of those in a vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, counts = 0, Counter()
                for part in _parts(text or b""):
                    words = part.split()
                    n += len(words)
                    counts.update(map(vocabulary.get, words))
                if n:
                    counts.pop(None, None)
                    rows.append((doc_id, n, list(counts.keys()), list(counts.values())))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
                columns = zip(zip(*rows, strict=True), kinds, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in columns], ["doc_id", "n", "terms", "tfs"]
                )

    return run


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all elements of some runs, one run after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def gains(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class Tree:
    """Documents as paths of a trie. ``terms`` are numbered by falling frequency and ascend within
    a document; every document has at least one."""

    def __init__(self, m: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        starts, raw = np.cumsum(lengths) - lengths, terms.astype(">u4").tobytes()
        path = [raw[4 * a : 4 * (a + n)] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
        #: Documents by path; below, a document is its place in this order.
        self.order = np.array(sorted(range(len(path)), key=path.__getitem__), np.int64)
        lengths = lengths[self.order]
        at = _ragged(starts[self.order], lengths)
        terms, self.tf, self.m = terms[at], tf[at], m[self.order]
        self.starts = np.cumsum(lengths) - lengths
        doc = np.repeat(np.arange(len(lengths)), lengths)
        depth = np.arange(len(terms)) - self.starts[doc]
        # An element whose path up to it is that of the document before lies in the same node.
        before = np.maximum(doc - 1, 0)
        other = np.minimum(self.starts[before] + depth, len(terms) - 1)
        same = (doc > 0) & (depth < lengths[before]) & (terms[other] == terms)
        shared = np.minimum.reduceat(np.where(same, depth.max(initial=0) + 1, depth), self.starts)
        new = depth >= shared[doc]
        by_depth = np.argsort(depth, kind="stable")
        first = np.flatnonzero(new[by_depth])
        last = np.append(first[1:], len(terms)) - 1
        head = by_depth[first]
        node_term = terms[head]
        by_term = np.argsort(node_term, kind="stable")
        #: Nodes by term: depth, documents from ``first`` to before ``end``, bounds over these.
        self.depth, self.first = depth[head][by_term], doc[head][by_term]
        self.end = doc[by_depth[last]][by_term] + 1
        self.most = np.maximum.reduceat(self.tf[by_depth], first)[by_term]
        self.least_m = np.minimum.reduceat(self.m[doc][by_depth], first)[by_term]
        self._term = node_term[by_term]

    def view(self, terms: np.ndarray, weights: np.ndarray) -> "View | None":
        """What an item sees: the nodes of its terms, of which every one has a weight above 0."""
        a, b = np.searchsorted(self._term, terms), np.searchsorted(self._term, terms, "right")
        nodes = _ragged(a, b - a)
        return View(self, nodes, np.repeat(weights, b - a)) if len(nodes) else None


class View:
    """A forest of the nodes of one item's terms, each below the nearest that contains it."""

    def __init__(self, tree: Tree, nodes: np.ndarray, weights: np.ndarray):
        order = np.lexsort((tree.depth[nodes], tree.first[nodes]))
        nodes = nodes[order]
        self.tree, self.weights, self.depth = tree, weights[order], tree.depth[nodes]
        self.first, self.end = tree.first[nodes], tree.end[nodes]
        gain = gains(self.weights, tree.most[nodes], tree.least_m[nodes])
        # Nodes that begin before or with a node and have not ended are those above it.
        level = np.arange(len(nodes)) - np.searchsorted(np.sort(self.end), self.first, "right")
        by_level = np.argsort(level, kind="stable")
        cuts = np.searchsorted(level[by_level], np.arange(level.max() + 2))
        self.levels = [by_level[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        self.parent, self.level = np.full(len(nodes), -1), level
        for above, own in zip(self.levels[:-1], self.levels[1:], strict=True):
            self.parent[own] = above[np.searchsorted(above, own) - 1]
        below, so_far = np.zeros(len(nodes), np.int64), gain.copy()
        for own in self.levels[:0:-1]:
            np.maximum.at(below, self.parent[own], gain[own] + below[own])
        for own in self.levels[1:]:
            so_far[own] += so_far[self.parent[own]]
        #: Upper bounds: of documents that end at a node, and of all that lie in it.
        self.here, self.high = so_far, so_far + below

    def children(self, node: int) -> np.ndarray:
        depth = self.level[node] + 1
        if depth == len(self.levels):
            return np.empty(0, np.int64)
        own = self.levels[depth]
        a, b = np.searchsorted(self.parent[own], [node, node + 1])
        return own[a:b]

    def documents(self, node: int, children: np.ndarray) -> np.ndarray:
        """Documents of a node that lie in none of its children."""
        a = np.concatenate([[self.first[node]], self.end[children]])
        b = np.concatenate([self.first[children], [self.end[node]]])
        return _ragged(a, b - a)

    def scores(self, node: int, documents: np.ndarray) -> np.ndarray:
        path = []
        while node >= 0:
            path.append(node)
            node = int(self.parent[node])
        tree = self.tree
        tf = tree.tf[tree.starts[documents][:, None] + self.depth[path]]
        return gains(self.weights[path], tf, tree.m[documents][:, None]).sum(1)


class Best:
    """The k best documents of an item: higher scores first, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc_id, self.missing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """The score that a document must reach."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc_id: np.ndarray, missing: np.ndarray) -> None:
        fits = score >= self.least
        if fits.any():
            score, doc_id, missing = (
                np.concatenate(x) for x in (
                    (self.score, score[fits]), (self.doc_id, doc_id[fits]), (self.missing, missing[fits])
                )
            )
            at = np.lexsort((doc_id, missing, -score))[: self.k]
            self.score, self.doc_id, self.missing = score[at], doc_id[at], missing[at]


def search(view: View, best: Best, doc_id: np.ndarray, missing: np.ndarray) -> int:
    """Depth first, the highest bound first; gives the number of documents scored."""
    scored = 0
    ascending = lambda nodes: nodes[np.argsort(view.high[nodes], kind="stable")].tolist()
    stack = [ascending(view.levels[0])]
    while stack:
        if not stack[-1] or view.high[stack[-1][-1]] < best.least:
            stack.pop()  # all that are left beside it have lower bounds
            continue
        node = stack[-1].pop()
        children = view.children(node)
        if view.here[node] >= best.least:
            own = view.documents(node, children)
            scored += len(own)
            at = view.tree.order[own]
            best.add(view.scores(node, own), doc_id[at], missing[at])
        children = children[view.high[children] >= best.least]
        if len(children):
            stack.append(ascending(children))
    return scored


def _searched(
    items: list[tuple[np.ndarray, np.ndarray]], number: np.ndarray, docs: int, length: int, k: int
):
    """``items``: numbers of terms by frequency, and their weights; ``number``: that of each term
    of the vocabulary."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, entries = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes = np.diff(part.column(2).offsets.to_numpy()).astype(np.int64)
                held.append((
                    part.column(0), part.column(1).to_numpy(), sizes,
                    part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy(),
                ))
                entries += int(sizes.sum())
                if entries >= TREE_ENTRIES:
                    yield tuple(zip(*held, strict=True))
                    held, entries = [], 0
        if entries:
            yield tuple(zip(*held, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(k) for _ in items]
        for ids, n, sizes, terms, tfs in trees(batches):
            column = pa.concat_arrays(ids)
            missing = column.is_null().to_numpy(zero_copy_only=False)
            doc_id = column.fill_null(0).to_numpy()
            n, sizes, terms, tfs = map(np.concatenate, (n, sizes, terms, tfs))
            if 90 * int(n.max()) * docs < 1 << 63:
                m = 10 + 90 * n * docs // length
            else:
                m = np.array([10 + 90 * x * docs // length for x in n.tolist()], np.int64)
            terms = number[terms]
            order = np.lexsort((terms, np.repeat(np.arange(len(sizes)), sizes)))
            terms, tfs = terms[order], tfs[order]
            some = np.flatnonzero(sizes)
            tree = Tree(m[some], sizes[some], terms, tfs)
            for (own, weights), best in zip(items, found, strict=True):
                view = tree.view(own, weights)
                if view:
                    search(view, best, doc_id[some], missing[some])
        which = np.repeat(np.arange(len(found)), [len(b.score) for b in found])
        if len(which):
            joined = lambda name: np.concatenate([getattr(b, name) for b in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(which), pa.array(joined("doc_id"), mask=joined("missing")), pa.array(joined("score"))],
                ["item", "doc_id", "score"],
            )

    return run


def _block(work: Work, docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best of every task for the items of one block."""
    spark = work.spark
    terms = sorted(set().union(*(r.terms for r in rows)))
    vocabulary = {bytes(t): i for i, t in enumerate(terms)}
    vectors = work.write(
        docs.mapInArrow(_vectors(vocabulary), "doc_id long, n long, terms array<int>, tfs array<long>"), keep=True
    )
    n, length = vectors.agg(F.count("*"), F.sum("n")).first()
    which, counts = collected(
        vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
        .select(F.col("t").cast("long").alias("t"), "df")
    )
    df = np.zeros(len(terms), np.int64)
    df[which] = counts
    number = np.empty(len(terms), np.int64)
    number[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    items = []
    for r in rows:
        own = [vocabulary[bytes(t)] for t in r.terms]
        weighed = sorted(
            (int(number[t]), math.floor(1000 * math.log((2 * n + 2) / (2 * int(df[t]) + 1)))) for t in own if df[t]
        )
        weighed = [x for x in weighed if x[1] > 0]
        items.append(tuple(np.array([x[i] for x in weighed], np.int64) for i in range(2)))
    found = vectors.select("doc_id", "n", "terms", "tfs").mapInArrow(
        _searched(items, number, n, length or 1, k), "item long, doc_id long, score long"
    )
    ids = [(i, r.item_id) for i, r in enumerate(rows)]
    named = spark.createDataFrame(ids, "item long, item_id long")
    return work.write(found.join(named, "item").select("item_id", "doc_id", "score"), keep=True)


def lexical_search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents with the highest scores above 0 for each item (fewer if there are fewer),
    ties by the smaller doc_id.

    Terms are runs of digits, letters A-Z (in lower case) and characters beyond ASCII; null texts
    have none. Rows of items with one item_id are one item with all of their terms, also those
    without an id; an item without terms has no rows. Every row of documents counts as one, also
    with a repeated doc_id; null ids come last among equals. An empty table gives no rows; further
    columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    docs = chosen(documents, doc_id="long", text="binary")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    with Work(spark, "lexical") as work:
        terms = chosen(items, item_id="long", text="binary").mapInArrow(_item_terms, "item_id long, terms array<binary>")
        terms = terms.select("item_id", F.explode("terms").alias("term"))
        wanted = work.write(terms.groupBy("item_id").agg(F.collect_set("term").alias("terms")))
        total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
        blocks = max(1, math.ceil(total / BLOCK_TERMS))
        place = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
        found = []
        for block in range(blocks):
            rows = wanted.where(place == block).orderBy("item_id").collect()
            if rows:
                found.append(_block(work, docs, rows, k))
        empty = spark.createDataFrame([], "item_id long, doc_id long, score long")
        best = reduce(DataFrame.union, found, empty) if len(found) != 1 else found[0]
        return (
            best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score")
        )


def op11_lexical_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
n AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM n),
m AS (SELECT doc_id, 10 + CAST((90 * n * docs) // len AS BIGINT) AS m FROM n, c),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, docs),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
