"""Written intermediate tables in the folder that all executors share."""

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """Inside the block, a stage whose generated method is longer than the JVM ever compiles (8000
    bytes) runs in smaller ones. Stages of many aggregates need it; it changes no result."""
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, str(min(8000, int(before))))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder named by the session."""
    base = spark.conf.get(_SETTING, None)
    if not base:
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    return f"{base.rstrip('/')}/cabmill-{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none if it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(folder) if f.isDirectory())


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where another one may lie."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already. Of several writers one succeeds."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(file)


# What results that are still lazy read, by application: their tables must outlive the call
# that made them, and go when the caller says so.
_RESULTS: dict[str, list[Callable[[], None]]] = {}


def on_release(spark: SparkSession, action: Callable[[], None]) -> None:
    _RESULTS.setdefault(spark.sparkContext.applicationId, []).append(action)


def release_results(spark: SparkSession) -> int:
    """Remove the tables that results of earlier calls read; call it once those are consumed."""
    actions = _RESULTS.pop(spark.sparkContext.applicationId, [])
    for action in reversed(actions):
        action()
    return len(actions)


class Scratch:
    """Owner of the written tables of one computation.

    A written table is computed once and does not depend on executors that may be lost later;
    reading it back also gives the planner its true size, which decides joins below. Leaving the
    `with` block removes the tables, except those written with `keep`: the result reads these,
    and `release_results` removes them.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self._paths: list[str] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_: object) -> None:
        for path in self._paths:
            remove(self.spark, path)
        self._paths.clear()

    def path(self, keep: bool = False) -> str:
        path = shared_dir(self.spark, self.label)
        if keep:
            on_release(self.spark, lambda: remove(self.spark, path))
        else:
            self._paths.append(path)
        return path

    def written(self, frame: DataFrame, keep: bool = False) -> DataFrame:
        path = self.path(keep)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a written table that a lazy result reads."""
    return Scratch(frame.sparkSession, label).written(frame, keep=True)
