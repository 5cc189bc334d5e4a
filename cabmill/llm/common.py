"""What the operators of this package share: scratch tables, columns, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cabmill

from cabmill.sources.shared import Scratch, remove


class Work(Scratch):
    """Scratch tables of one run of an operator; any of them may go before the block ends."""

    def __init__(self, spark: SparkSession, label: str):
        super().__init__(spark, label)
        self._tables: list[tuple[DataFrame, str]] = []

    def write(self, frame: DataFrame, keep: bool = False) -> DataFrame:
        path = self.path(keep)
        frame.write.parquet(path)
        table = self.spark.read.schema(frame.schema).parquet(path)
        if not keep:
            self._tables.append((table, path))
        return table

    def drop(self, table: DataFrame) -> None:
        """Remove a table now, to free its disk."""
        for known in [x for x in self._tables if x[0] is table]:
            remove(self.spark, known[1])
            self._tables.remove(known)
            self._paths.remove(known[1])


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this library, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        package = Path(cabmill.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="cabmill-")) / "cabmill-code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))  # Spark sends it to every executor


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """Inside the block, tasks that run send whole texts to their Python workers in batches of so many
    rows at most, not of 10000, which both sides would hold at once. It changes no result."""
    before = spark.conf.get(_BATCH_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What a Python worker keeps between its tasks: one value at a time. It goes when a task asks for
    another key, or when one that keeps nothing calls ``let_go``: workers outlive stages and jobs, and
    each executor has several of them."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    _KEPT.clear()


def chosen(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, each cast; further columns of the input, whatever their names,
    never meet the names an operator uses inside."""
    return frame.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()))


def crc_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id's decimal text modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def smallest_hashes(frame: DataFrame, column: str, seed: str, k: int) -> DataFrame:
    """At most k rows: those with the smallest hashes of a column, ties by the column.

    Rows that can't be among them by chance are left out first, so that tasks send about 2 k rows
    in all, however many tasks there are.
    """
    n, top = frame.count(), 1 << 40
    place = F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(top))
    if n > 4 * k:
        few = frame.where(place < int(top * 2 * k / n))
        # Where many rows share few values, none or too few may lie below by chance.
        if few.limit(k).count() == k:
            frame = few
    return frame.orderBy(place, column).limit(k)


def _packed_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c.to_numpy().astype("<i8").tobytes()], pa.binary()) for c in batch.columns],
            batch.schema.names,
        )


def collected(frame: DataFrame) -> list[np.ndarray]:
    """Columns of whole numbers of a frame of bounded size, packed on the way to the driver."""
    schema = ", ".join(f"`{c}` binary" for c in frame.columns)
    rows = frame.mapInArrow(_packed_columns, schema).collect()
    return [np.frombuffer(b"".join(r[i] for r in rows), "<i8") for i in range(len(frame.columns))]


def components(work: Work, links: DataFrame) -> DataFrame:
    """(node, comp) for every node that has a link; comp is the smallest node it reaches.

    ``links`` has two long columns a, b. Each round hangs the larger neighbours of every node
    on its smallest one, then the smaller ones (large star, small star), until nothing changes.
    A node's neighbours never meet in one task: both steps are minima and joins.
    """
    pair = lambda a, b: (F.col(a).alias("a"), F.col(b).alias("b"))
    edges = work.write(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    told = None
    while True:
        both = edges.union(edges.select(*pair("b", "a")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        star = work.write(
            both.where("b > a").join(low, "a").select(*pair("b", "m")).distinct()
        )
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        small = work.write(
            star.join(least, "a").where("b <> m").select(*pair("b", "m"))
            .union(least.select(*pair("a", "m"))).distinct()
        )
        work.drop(star)
        work.drop(edges)
        edges, before = small, told
        # Equal sums over two rounds: no edge has changed.
        told = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if told == before or not told[0]:
            roots = edges.select("b").distinct().select(*pair("b", "b"))
            return edges.union(roots).toDF("node", "comp")
