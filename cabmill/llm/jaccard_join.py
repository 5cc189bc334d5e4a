"""Jaccard join of documents on word n-grams: a blocked sparse product of incidence matrices.

The matrix has a row per distinct n-gram set and a column per n-gram. The product of the matrix
with its transpose holds the overlap of every pair, and it is built column by column:

1. Equal sets are one row. The rows of a group of copies are therefore never paired.
2. Columns are ordered, frequent ones last. Sets of n n-grams that reach the threshold share one
   of their first n - ceil(t n) + 1 columns, so only these entries are multiplied. The order
   affects cost alone; any order gives the same links.
3. A column with one entry adds to no overlap and goes. What it takes from a row lowers the
   overlap that row can reach; pairs whose bound falls below the least overlap for their sizes
   are not formed.
4. Star rounds compare each row with one pivot per column and join those that link exactly.
   What is left to multiply are pairs of rows in different components.
5. Short columns give partial overlaps, added up within a task, then over all tasks. A long column
   is cut into blocks of rows, and each pair of blocks is a cell of its own, so no task holds a
   column; a cell multiplies its rows over all their prefix columns at once, so only pairs whose
   whole count reaches the bound leave it, each from the first long column it shares.
6. Pairs below the size-derived bound go, and the rest are counted exactly on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import Work, chosen, collected, components, let_go, read, small_batches
from cabmill.llm.shingles import fingerprint, shingle_sets

#: Shingles counted together when frequent ones are looked for.
_CHUNK = 2_000_000
#: Most frequent shingles put last. The bound keeps the broadcast below 10 MB at any input size;
#: those beyond it keep their place in the order of hashes, which costs time but loses no link.
FREQUENT = 500_000
#: Entries from which on a column is long; rows of a long column in one block; columns of a cell
#: that are multiplied at a time. Results do not depend on them.
_LONG, _BLOCK, _SLICE = 64, 512, 4096
#: Candidate rows whose ids may be broadcast (8 bytes each); beyond, Spark picks the join.
_BROADCAST_ROWS = 1_000_000
_LAST = 1 << 62  # keys of frequent shingles start here; hashes are below


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
    )


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _profiles(size: int):
    """Per document its set's size and fingerprint; per shingle that repeats among the distinct
    sets of a chunk, how often it does (doc_row null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held, seen, total = [], set(), 0

        def counted():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            more = counts > 1
            k = int(more.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.array(keys[more]), pa.array(counts[more].astype(np.int64)),
                 pa.nulls(k, pa.binary())],
                ["doc_id", "n", "df", "fp"],
            )

        for batch in _sliced(batches):
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            sizes, prints = [], []
            for s in shingle_sets(texts, size):
                fp = fingerprint(s)
                sizes.append(len(s))
                prints.append(fp)
                if len(s) and fp not in seen:
                    seen.add(fp)
                    held.append(s)
                    total += len(s)
                    if total >= _CHUNK:
                        yield counted()
                        held, seen, total = [], set(), 0
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.nulls(len(sizes), pa.int64()),
                 pa.array(prints, pa.binary())],
                ["doc_id", "n", "df", "fp"],
            )
        if held:
            yield counted()
        pa.default_memory_pool().release_unused()

    return run


def _prefixes(size: int, percent: int, frequent):
    """(fp, n, prefix) of every document that has shingles; the prefix as keys in column order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rank = frequent.value
        for batch in _sliced(batches):
            out: list[tuple] = []
            for s in shingle_sets(batch.column(0).to_pylist(), size):
                n = len(s)
                if not n:
                    continue
                order = s
                if len(keys):
                    at = np.searchsorted(keys, s)
                    at[at == len(keys)] = 0
                    order = np.where(keys[at] == s, _LAST + rank[at], s)
                    order.sort()
                p = n - -(-percent * n // 100) + 1
                out.append((fingerprint(s), n, order[:p]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
                 _lists([x[2] for x in out])],
                ["fp", "n", "prefix"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            sets = list(shingle_sets(batch.column(0).to_pylist(), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([fingerprint(s) for s in sets], pa.binary()),
                 _lists(sets)],
                ["fp", "shingles"],
            )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by their first column, those whose value occurs more than once."""
    last, out_already = None, False  # the row that waits for its successor, and whether it is out
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if last is None else [last, batch])
        key = rows.column(0).to_numpy()
        same = key[1:] == key[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        last_kept = bool(keep[-1])
        if last is not None and out_already:
            keep[0] = False
            last_kept |= len(key) == 1
        yield from rows.filter(pa.array(keep)).to_batches()
        last, out_already = rows.slice(len(key) - 1).combine_chunks().to_batches()[0], last_kept


def _least(percent: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Overlap that sets of these sizes need to link."""
    return -(-percent * (a + b) // (100 + percent))


def _runs(batches: Iterator[pa.RecordBatch], by: list[str], whole: bool) -> Iterator[pa.Table]:
    """Rows sorted by some columns, cut only between their values; one value at a time if whole."""
    held: list[pa.RecordBatch] = []

    def cuts(rows: pa.RecordBatch) -> list[int]:
        change = np.zeros(max(0, rows.num_rows - 1), bool)
        for name in by:
            change |= np.diff(rows.column(name).to_numpy()) != 0
        return (np.flatnonzero(change) + 1).tolist()

    def same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(c)[a.num_rows - 1] == b.column(c)[0] for c in by)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not same(held[-1], batch):
            yield pa.Table.from_batches(held)
            held = []
        edges = cuts(batch)
        if not edges:
            held.append(batch)
            continue
        for a, b in zip([0, *edges[:-1]], edges, strict=True) if whole else [(0, edges[-1])]:
            yield pa.Table.from_batches([*held, batch.slice(a, b - a)])
            held = []
        held = [batch.slice(edges[-1])]
    if held:
        yield pa.Table.from_batches(held)


def _product(percent: int):
    """Partial overlaps of the pairs of short columns; rows come sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0

        def summed():
            both, counts = np.unique(np.concatenate(found), axis=0, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(counts.astype(np.int64))],
                ["x", "y", "overlap"],
            )

        for rows in _runs(batches, ["key"], whole=False):
            key, node, comp, n, reach = (
                rows.column(c).to_numpy() for c in ("key", "node", "comp", "n", "reach")
            )
            edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                i, j = np.triu_indices(b - a, 1)
                i, j = i + a, j + a
                good = (comp[i] != comp[j]) & (
                    np.minimum(reach[i], reach[j]) >= _least(percent, n[i], n[j])
                )
                x, y = node[i[good]], node[j[good]]
                if len(x):
                    found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
                    size += len(x)
                if size > 1_000_000:
                    yield summed()
                    found, size = [], 0
        if found:
            yield summed()

    return run


def _block_product(percent: int):
    """Pairs of a cell of a long column whose overlap in all prefix columns reaches the bound, if
    this is the first long column they share; rows come sorted by (key, cell)."""

    def counted(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        """Shared columns of every left and right row: a product of incidence matrices."""
        names = np.unique(np.concatenate(left + right))
        out = np.zeros((len(left), len(right)), np.float32)
        sides = []
        for rows in (left, right):
            at = np.searchsorted(names, np.concatenate(rows))
            sides.append((np.repeat(np.arange(len(rows)), [len(r) for r in rows]), at))
        for a in range(0, len(names), _SLICE):
            parts = []
            for (row, at), rows in zip(sides, (left, right), strict=True):
                part = np.zeros((len(rows), min(_SLICE, len(names) - a)), np.float32)
                inside = (at >= a) & (at < a + _SLICE)
                part[row[inside], at[inside] - a] = 1
                parts.append(part)
            out += parts[0] @ parts[1].T
        return out.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _runs(batches, ["key", "cell"], whole=True):
            side = cell.column("side").to_numpy()
            i, j = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
            node, comp, n, reach, p = (
                cell.column(c).to_numpy() for c in ("node", "comp", "n", "reach", "p")
            )
            a, b = i[:, None], j[None, :]
            least = _least(percent, n[a], n[b])
            good = (comp[a] != comp[b]) & (np.minimum(reach[a], reach[b]) >= least)
            good &= (node[a] < node[b]) | (side[a] < 0)
            rows, others = good.any(1), good.any(0)
            if not rows.any():
                continue
            i, j, good, least = i[rows], j[others], good[rows][:, others], least[rows][:, others]
            columns, longs = (
                [np.asarray(x) for x in cell.column(c).to_pylist()] for c in ("columns", "longs")
            )
            overlap = counted([columns[k] for k in i], [columns[k] for k in j])
            # All overlap in the prefixes is counted; the rest lies behind the end of one prefix.
            good &= overlap + np.maximum((n - p)[i][:, None], (n - p)[j][None, :]) >= least
            key, pairs = cell.column("key")[0].as_py(), []
            for k, m in zip(*np.nonzero(good), strict=True):
                x, y = int(i[k]), int(j[m])
                if np.intersect1d(longs[x], longs[y], assume_unique=True)[0] == key:
                    pairs.append((min(node[x], node[y]), max(node[x], node[y])))
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["x", "y"]
                )

    return run


def _most_frequent(spark: SparkSession, profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys ascending and the rank of each by frequency: at most FREQUENT of them."""
    counts = profiles.where("fp IS NULL").groupBy("n").agg(F.sum("df").alias("df"))
    level, total = 2, 0
    # One row per frequency with less than a chunk's worth of keys below it: bounded by log2.
    by_power = (
        counts.groupBy(F.floor(F.log2("df")).alias("p")).count().orderBy(F.desc("p")).collect()
    )
    for row in by_power:
        total += row["count"]
        if total > FREQUENT:
            level = 2 ** (row["p"] + 1)
            break
    keys, df = collected(counts.where(F.col("df") >= level).select("n", "df"))
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, df))] = np.arange(len(keys))
    order = np.argsort(keys)
    return keys[order], rank[order]


def jaccard_components(
    documents: DataFrame, percent: int = 80, size: int = 5, star_rounds: int = 1
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when their shingle sets overlap by at least ``percent`` % of their union.
    component_id is the smallest doc_id reachable by links, the document's own included.

    Null and empty texts, and texts of white space, have no shingles and link with nothing. A
    text of fewer than ``size`` words is one shingle. Repeated rows are copies of each other; a
    row with a null doc_id takes part but lends no id (its component_id is null if no other has
    one). An empty table gives no rows; further columns are ignored.
    """
    spark = documents.sparkSession
    docs = chosen(documents, doc_id="long", text="string")
    with Work(spark, "jaccard") as work:
        with small_batches(spark):
            profiles = work.write(
                docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
                    _profiles(size), "doc_id long, n long, df long, fp binary"
                ),
                keep=True,
            )
        sets = profiles.where("fp IS NOT NULL")
        frequent = spark.sparkContext.broadcast(_most_frequent(spark, profiles))
        with small_batches(spark):
            rows = work.write(
                docs.select(F.col("text").cast("binary"))
                .mapInArrow(_prefixes(size, percent, frequent), "fp binary, n long, prefix array<long>")
                .groupBy("fp").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
                .withColumn("node", F.monotonically_increasing_id())
            )
        entries = _entries(work, rows)
        nodes = work.write(
            sets.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("first_id"))
            .join(rows.select("fp", "node", "n"), "fp"),
            keep=True,
        )
        work.drop(rows)
        links, comps = None, None
        for r in range(star_rounds):
            found = _verified(work, docs, nodes, _stars(work, entries, comps, percent, r), percent, size)
            links = work.write(found if links is None else links.union(found))
            comps = work.write(components(work, links))
        rest = _candidates(work, entries, nodes, comps, percent)
        found = _verified(work, docs, nodes, rest, percent, size)
        comps = work.write(components(work, links.union(found)), keep=True)
        frequent.unpersist()

    named = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = named.join(
        named.groupBy("comp").agg(F.min("first_id").alias("component_id")), "comp"
    ).select("fp", "component_id")
    return sets.join(named, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _entries(work: Work, rows: DataFrame) -> DataFrame:
    """(key, node, n, reach) of the prefix columns that hold more than one entry.

    reach is the largest overlap the row can have: its size less its own single columns.
    """
    long = rows.select("node", "n", F.size("prefix").alias("p"), F.explode("prefix").alias("key"))
    kept = work.write(
        long.where(F.col("key") >= _LAST).select("key", "node", "n", "p").union(
            long.where(F.col("key") < _LAST).select("key", "node", "n", "p")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(_repeated, "key long, node long, n long, p int")
        )
    )
    reach = kept.groupBy("node").agg((F.first("n") - F.first("p") + F.count("*")).alias("reach"))
    return work.write(kept.join(reach, "node").select("key", "node", "n", "reach"))


def _may_link(percent: int):
    """Bound from sizes: the least overlap of a linked pair must be within reach of both."""
    least = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    return F.least("x.reach", "y.reach") >= least


def _open(work: Work, entries: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Entries with their row's component, of columns that meet more than one component."""
    if comps is None:
        return entries.withColumn("comp", F.col("node"))
    with_comp = entries.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = with_comp.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return with_comp.join(mixed.where("lo < hi").select("key"), "key")


def _stars(work: Work, entries: DataFrame, comps: DataFrame | None, percent: int, turn: int) -> DataFrame:
    """At most one pair per row: with the pivot of its columns that it shares most of them with."""
    rows = work.write(_open(work, entries, comps))
    ease = F.col("reach") / F.col("n") if turn == 0 else F.xxhash64("comp", F.lit(turn))
    pivots = rows.groupBy("key").agg(F.max(F.struct(ease, "node", "n", "reach", "comp")).alias("y"))
    pairs = (
        rows.alias("x").join(pivots.select("key", "y.*").alias("y"), "key")
        .where(F.col("x.comp") != F.col("y.comp")).where(_may_link(percent))
        .groupBy(F.col("x.node").alias("x"), F.col("y.node").alias("y")).agg(F.count("*").alias("c"))
    )
    return pairs.groupBy("x").agg(F.max(F.struct("c", "y")).alias("m")).select("x", F.col("m.y").alias("y"))


def _candidates(work: Work, entries: DataFrame, nodes: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows in different components whose overlap may reach the threshold."""
    rows = work.write(_open(work, entries, comps))
    long = rows.groupBy("key").count().where(F.col("count") > _LONG)
    marked = work.write(rows.join(long, "key", "left"))
    products = (
        marked.where("count IS NULL").select("key", "node", "comp", "n", "reach")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_product(percent), "x long, y long, overlap long")
    )
    sizes = nodes.select("node", "n")
    ceil = lambda c: F.ceil(percent * F.col(c) / 100)
    short = (
        products.groupBy("x", "y").agg(F.sum("overlap").alias("c"))
        .join(sizes.select(F.col("node").alias("x"), F.col("n").alias("nx")), "x")
        .join(sizes.select(F.col("node").alias("y"), F.col("n").alias("ny")), "y")
        .where(
            F.col("c") + F.greatest(ceil("nx"), ceil("ny")) - 1
            >= F.ceil(percent * (F.col("nx") + F.col("ny")) / (100 + percent))
        )
        .select("x", "y")
    )
    # Rows of long columns with all their columns: a node has no more than its prefix.
    whole = marked.groupBy("node").agg(
        F.sort_array(F.collect_list("key")).alias("columns"),
        F.sort_array(F.collect_list(F.when(F.col("count") > _LONG, F.col("key")))).alias("longs"),
    ).where(F.size("longs") > 0)
    cut = marked.where("count IS NOT NULL").withColumn(
        "blocks", F.ceil(F.col("count") / _BLOCK).cast("int")
    ).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Cell (i, j), i <= j: rows of block i on the left, of block j on the right; 0: both.
    cells = (
        cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key",
            (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).cast("long").alias("cell"),
            F.signum(F.col("block") - F.col("other")).cast("int").alias("side"),
            "node", "comp", "n", "reach", (F.col("n") - ceil("n") + 1).cast("long").alias("p"),
        )
        .join(work.write(whole), "node")
    )
    blocks = (
        cells.select("key", "cell", "side", "node", "comp", "n", "reach", "p", "columns", "longs")
        .repartition("key", "cell").sortWithinPartitions("key", "cell")
        .mapInArrow(_block_product(percent), "x long, y long")
    )
    return short.union(blocks).distinct()


def _verified(work: Work, docs: DataFrame, nodes: DataFrame, pairs: DataFrame, percent: int, size: int) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the threshold."""
    pairs = work.write(pairs)
    wanted = nodes.join(
        pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct(), "node"
    ).select("node", "fp", "first_id")
    wanted = work.write(wanted)
    ids = wanted.select("first_id").distinct()
    if ids.count() <= _BROADCAST_ROWS:
        ids = F.broadcast(ids)
    sets = (
        docs.join(ids, docs["doc_id"].eqNullSafe(ids["first_id"]), "left_semi")
        .select(F.col("text").cast("binary"))
        .mapInArrow(_sets(size), "fp binary, shingles array<long>")
        .groupBy("fp").agg(F.first("shingles").alias("s"))
    )
    with small_batches(work.spark):
        sets = work.write(wanted.select("node", "fp").join(sets, "fp").select("node", "s"))
    both = pairs.join(sets.select(F.col("node").alias("x"), F.col("s").alias("sx")), "x").join(
        sets.select(F.col("node").alias("y"), F.col("s").alias("sy")), "y"
    )
    shared = F.size(F.array_intersect("sx", "sy"))
    found = work.write(
        both.where(shared * (100 + percent) >= percent * (F.size("sx") + F.size("sy")))
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    work.drop(sets)
    return found


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))
