"""Materialised models: versions of physical tables, published per environment as views.

A physical table lives in `<namespace>_physical` and belongs to one environment; readers use the
view `<schema>__<env>.<model>` (`<schema>.<model>` in production). Four kinds of write:

* `replace_interval`  recompute the days [start, end] of a large table, stored by day;
* `replace_days`      the same for a small table, as a new version of the whole;
* `refresh`           rebuild the whole table as a new version;
* `upsert`            merge a batch by key into a table stored by hash buckets of the key.

Every write makes a new version and leaves the files of all others alone; the view switches to it
when it is complete. A write that fails, or is killed half-way, leaves readers with the version
they had, whole. Versions of a large table share folders: each day (or bucket) of a write is a
folder that never changes, and a version is a list of the folders that belong to it, kept as a
small table and as the partitions of a catalog table. So a new version writes only the days of
its interval, or the buckets that its batch touches, and an older one can still be read by name.
"""

import getpass
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from cabmill.operators.quality import check_output_shape
from cabmill.sources.shared import Scratch, child_folders, claim, remove

PRODUCTION = "prod"
_HIDDEN_DAY, _HIDDEN_BUCKET, _PLACE = "part_day", "part_bucket", "part_place"
_SOURCE = "cabmill.table"  # property of a view: the physical table it reads
_KEYED = "cabmill.buckets"  # property of a bucketed version: number of buckets, columns of the key
#: Buckets of a table that is written by key. An upsert rewrites those that its batch touches.
BUCKETS = 64
# Stored rows are written once and kept by several versions: a fifth to a third smaller than by default.
_CODEC = "zstd"
# Partitions named in one statement.
_AT_ONCE = 500


def default_environment() -> str:
    """`dev_<user>`: production is written only by those who name it."""
    return "dev_" + re.sub(r"\W", "_", getpass.getuser())


@dataclass
class Store:
    spark: SparkSession
    location: str  # shared folder that holds the physical tables
    env: str = field(default_factory=default_environment)
    namespace: str = "cabmill"
    _pending: dict[str, tuple[str, list[str]]] | None = field(default=None, init=False)

    @property
    def physical(self) -> str:
        return f"{self.namespace}_physical"

    def create(self) -> "Store":
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.physical} LOCATION '{self.location}'"
        )
        return self

    def drop(self) -> None:
        """Remove the views of all environments, every physical table and every folder."""
        for schema in self._schemas():
            self.spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.physical} CASCADE")
        for folder in ("data", "lists", "claims"):
            remove(self.spark, f"{self.location}/{folder}")

    # -- names and views -------------------------------------------------------------------

    def view(self, model: str) -> str:
        schema, name = model.split(".")
        suffix = "" if self.env == PRODUCTION else f"__{self.env}"
        return f"{schema}{suffix}.{name}"

    def _table(self, model: str) -> str:
        return f"{self.physical}.{self.env}__{model.replace('.', '__')}".lower()

    def _schemas(self) -> list[str]:
        """Databases that hold views of this store, of any environment: each has a folder."""
        return child_folders(self.spark, f"{self.location}/views")

    def read(self, model: str, at: str | None = None) -> DataFrame:
        """The rows that this environment's readers see; `at` names a kept state, or a version."""
        if at is not None:
            if at in self.versions(model):
                return self._rows(at)
            return self.spark.table(self._kept_view(model, at))
        if self._pending and model in self._pending:
            table, columns = self._pending[model]
            return self.spark.table(table).select(*columns)
        return self.spark.table(self.view(model))

    def _rows(self, table: str) -> DataFrame:
        """A version without its hidden column; other columns in the order of the table."""
        return self.spark.table(table).drop(_HIDDEN_DAY, _HIDDEN_BUCKET)

    def _kept_view(self, model: str, label: str) -> str:
        return f"{self.view(model)}__at_{label}"

    def keep(self, model: str, label: str) -> None:
        """Give the state that readers see now a name. It stays readable, `read(model, label)`,
        whatever is written later, until it is forgotten."""
        table = self.published(model)
        if table is None:
            raise ValueError(f"{model} is not published")
        columns = self.read(model).columns
        self._create_view(self._kept_view(model, label), table, columns)

    def forget(self, model: str, label: str) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self._kept_view(model, label)}")

    def publish(self, model: str, table: str, columns: Sequence[str]) -> None:
        """Let this environment's view of the model read a physical table."""
        if self._pending is not None:
            self._pending[model] = table, list(columns)
            return
        self._create_view(self.view(model), table, columns)

    def _create_view(self, view: str, table: str, columns: Sequence[str]) -> None:
        # A schema of views only; it lies beside the physical tables, so every driver sees it.
        schema = view.split(".")[0]
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{self.location}/views/{schema}'"
        )
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{_SOURCE}' = '{table}')"
            f" AS SELECT {', '.join(columns)} FROM {table}"
        )

    @contextmanager
    def one_switch(self) -> Iterator[None]:
        """Writes inside the block are published together at its end, and not at all if it
        fails; inside, `read` sees them."""
        self._pending = {}
        try:
            yield
            pending = self._pending
        finally:
            self._pending = None
        for model, (table, columns) in pending.items():
            self.publish(model, table, columns)

    def published(self, model: str) -> str | None:
        """The physical table that this environment's readers see."""
        if self._pending and model in self._pending:
            return self._pending[model][0]
        if not self.spark.catalog.tableExists(self.view(model)):
            return None
        return self._source(self.view(model))

    def _source(self, view: str) -> str | None:
        return self._property(view, _SOURCE)

    def fork(self, source: "Store", models: Sequence[str]) -> None:
        """Start from another environment's rows: views only. Later writes share the folders of
        days and buckets that they leave alone, which no environment ever changes."""
        for model in models:
            self.publish(model, source.published(model), source.read(model).columns)

    # -- versions that are lists of folders ------------------------------------------------

    def _new_version(self, model: str) -> str:
        """The next version's table name. Its number is claimed by a file that only one of
        several writers can create; the random tail keeps a retry clear of other files."""
        versions = self.versions(model)
        number = int(versions[-1].rsplit("__v", 1)[1].split("_")[0]) + 1 if versions else 1
        name = self._table(model).split(".")[1]
        while not claim(self.spark, f"{self.location}/claims/{name}__v{number:06d}"):
            number += 1
        return f"{self._table(model)}__v{number:06d}_{uuid.uuid4().hex[:8]}"

    def _list_path(self, table: str) -> str:
        return f"{self.location}/lists/{table.split('.')[1]}"

    def parts(self, table: str) -> dict[str, str] | None:
        """Folders of a version by day or bucket; None for a version that is one table."""
        if table.split(".")[1] not in child_folders(self.spark, f"{self.location}/lists"):
            return None
        rows = self.spark.read.schema("part string, folder string").parquet(self._list_path(table))
        return {r.part: r.folder for r in rows.collect()}

    def _write_parts(self, table: str, rows: DataFrame, part: str) -> dict[str, str]:
        """Write rows in one folder per value of `part`, none of which any version knows yet."""
        folder = f"{self.location}/data/{table.split('.')[1]}"
        try:
            rows.write.option("compression", _CODEC).partitionBy(part).parquet(folder)
        except BaseException:
            remove(self.spark, folder)
            raise
        found = child_folders(self.spark, folder)
        return {name.split("=", 1)[1]: f"{folder}/{name}" for name in found if "=" in name}

    def _create_version(
        self, table: str, schema: StructType, part: str, parts: dict[str, str], properties: dict[str, str]
    ) -> None:
        """The list of a version, and the catalog table that reads its folders. The table owns
        none of them: dropping it removes no file."""
        entries = self.spark.createDataFrame(sorted(parts.items()), "part string, folder string")
        entries.coalesce(1).write.parquet(self._list_path(table))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        listed = "".join(f", '{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({part})"
            f" LOCATION '{self.location}/none' TBLPROPERTIES ('cabmill.part' = '{part}'{listed})"
        )
        literal = "DATE '{}'" if isinstance(schema[part].dataType, DateType) else "{}"
        named = [f"PARTITION ({part} = {literal.format(p)}) LOCATION '{f}'" for p, f in parts.items()]
        for at in range(0, len(named), _AT_ONCE):
            self.spark.sql(f"ALTER TABLE {table} ADD {' '.join(named[at : at + _AT_ONCE])}")

    # -- replace an interval ---------------------------------------------------------------

    def replace_interval(
        self, model: str, batch: DataFrame, time_column: str, start: date, end: date,
        clustered: bool = False, curve: str | None = None,
    ) -> str:
        """A new version that holds exactly `batch` for the days start..end, and the folders of
        the published one for all other days, which are neither read nor written.

        The table is stored by `time_column` if that is a date, so that a filter on it prunes
        the published view; else by a hidden day (`interval` prunes by it). `clustered` says that
        the batch already comes in files of few days (a narrow step over such a table), which
        spares the shuffle that otherwise gathers each day into few files. That shuffle is a
        rebalance: a day that holds a large part of all rows is split over tasks. With `curve`, an
        expression that numbers rows (`expressions.on_curve`), the rows of a day are ranged over
        tasks and sorted by it instead, so that a filter on the columns of the curve skips files
        and row groups by their least and greatest values.
        """
        check_output_shape(batch.columns)
        rows, part = self._with_day(batch, time_column)
        inside = f"{part} BETWEEN DATE '{start}' AND DATE '{end}'"
        rows = rows.where(inside)
        kept: dict[str, str] = {}
        if published := self.published(model):
            held = self.read(model)
            check_same_columns(held, batch)
            if self._part_column(published) == part:
                kept = {d: f for d, f in self.parts(published).items() if not str(start) <= d <= str(end)}
            else:  # written as one table until now: its other days move into folders
                older, _ = self._with_day(held, time_column)
                rows = rows.unionByName(older.where(f"NOT ({inside})"))
        schema = rows.schema
        if curve:
            place = F.expr(curve).alias(_PLACE)
            rows = rows.select("*", place).repartitionByRange(part, _PLACE)
            rows = rows.sortWithinPartitions(part, _PLACE).drop(_PLACE)
        elif not clustered:
            rows = rows.hint("rebalance", part)
        table = self._new_version(model)
        parts = kept | self._write_parts(table, rows, part)
        self._create_version(table, schema, part, parts, {})
        self.publish(model, table, batch.columns)
        return table

    def interval(self, model: str, time_column: str, start: date, end: date) -> DataFrame:
        """Rows of the days start..end, read with partition pruning."""
        rows = self.spark.table(self.published(model))
        part = time_column if isinstance(rows.schema[time_column].dataType, DateType) else _HIDDEN_DAY
        rows = rows.where(f"{part} BETWEEN DATE '{start}' AND DATE '{end}'")
        return rows.drop(_HIDDEN_DAY)

    def _property(self, table: str, name: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{name}'").collect()
        return rows[0].value if rows else None

    def _part_column(self, table: str) -> str | None:
        return self._property(table, "cabmill.part")

    def replace_days(
        self, model: str, batch: DataFrame, time_column: str, start: date, end: date
    ) -> None:
        """The same for a small table, as a new version: the days outside the interval are read
        from the version now published, which stays as it is."""
        within = F.expr(f"CAST({time_column} AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'")
        rows = batch.where(within)
        if self.published(model):
            kept = self.read(model)
            check_same_columns(kept, batch)
            rows = rows.unionByName(kept.where(~F.coalesce(within, F.lit(False))))
        self.refresh(model, rows.select(*batch.columns))

    @staticmethod
    def _with_day(batch: DataFrame, time_column: str) -> tuple[DataFrame, str]:
        if isinstance(batch.schema[time_column].dataType, DateType):
            return batch, time_column
        return batch.withColumn(_HIDDEN_DAY, F.col(time_column).cast("date")), _HIDDEN_DAY

    # -- full refresh and upsert -----------------------------------------------------------

    def refresh(self, model: str, frame: DataFrame) -> str:
        """Write a new version of the whole table and switch the view to it."""
        check_output_shape(frame.columns)
        table = self._new_version(model)
        frame.write.format("parquet").option("compression", _CODEC).saveAsTable(table)
        self.publish(model, table, frame.columns)
        return table

    def upsert(
        self, model: str, batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = (),
        buckets: int = BUCKETS,
    ) -> str:
        """Insert the batch, replacing rows with the same key; NULL keys match each other.

        If the batch repeats a key, its largest row by `order_by` (then by all columns) wins. The
        table is stored by buckets of the key's hash. Only the buckets that the batch touches are
        read, merged and written; the new version carries all others over. `buckets` counts for a
        table that has none yet, or other keys, and is therefore written as a whole.
        """
        check_output_shape(batch.columns)
        published, keyed = self.published(model), ",".join(key)
        stored = self._property(published, _KEYED) if published else None
        if stored and stored.split(":", 1)[1] == keyed:
            buckets = int(stored.split(":", 1)[0])
        else:
            stored = None
        with Scratch(self.spark, "upsert") as scratch:
            # Computed once, though the merge reads it twice; if small, it is broadcast.
            latest = scratch.written(last_per_key(batch, key, order_by).withColumn(_HIDDEN_BUCKET, _bucket(key, buckets)))
            kept: dict[str, str] = {}
            rows = latest
            if published:
                check_same_columns(self.read(model), batch)
                if stored:
                    touched = {str(r[0]) for r in latest.select(_HIDDEN_BUCKET).distinct().collect()}
                    kept = {b: f for b, f in self.parts(published).items() if b not in touched}
                    current = self.spark.table(published)
                    # As constants, so that only the folders of these buckets are listed and read.
                    current = current.where(F.col(_HIDDEN_BUCKET).isin([int(b) for b in touched]))
                else:
                    current = self.read(model).withColumn(_HIDDEN_BUCKET, _bucket(key, buckets))
                rows = merge_by_key(current.select(*latest.columns), latest, key)
            table = self._new_version(model)
            parts = kept | self._write_parts(table, rows.hint("rebalance", _HIDDEN_BUCKET), _HIDDEN_BUCKET)
        self._create_version(table, rows.schema, _HIDDEN_BUCKET, parts, {_KEYED: f"{buckets}:{keyed}"})
        self.publish(model, table, batch.columns)
        return table

    def versions(self, model: str) -> list[str]:
        """This environment's written versions, oldest first."""
        prefix = self._table(model).split(".")[1] + "__v"
        tables = self.spark.sql(f"SHOW TABLES IN {self.physical} LIKE '{prefix}*'").collect()
        return sorted(f"{self.physical}.{t.tableName}" for t in tables)

    def drop_old_versions(self, *models: str, keep: int = 2) -> None:
        """Drop all but the newest versions and those that a view of any environment reads, and
        the folders that only dropped versions list. A writer at work starts from a published
        version, so its folders are never among these."""
        read = {
            self._source(f"{schema}.{v.viewName}")
            for schema in self._schemas()
            for v in self.spark.sql(f"SHOW VIEWS IN {schema}").collect()
            if not v.isTemporary
        }
        if self._pending:
            read |= {table for table, _ in self._pending.values()}
        gone = {t for m in models for t in self.versions(m)[:-keep] if t not in read}
        loose: set[str] = set()
        for table in gone:
            loose |= set((self.parts(table) or {}).values())
            self.spark.sql(f"DROP TABLE {table}")
            remove(self.spark, self._list_path(table))
        if loose:
            lists = child_folders(self.spark, f"{self.location}/lists")
            for name in lists:
                loose -= set(self.parts(f"{self.physical}.{name}").values())
        for folder in loose:
            remove(self.spark, folder)


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def check_same_columns(held: DataFrame, batch: DataFrame) -> None:
    """Refuse a batch with missing, extra or retyped columns; their order is free."""
    want = {f.name: f.dataType.simpleString() for f in held.schema}
    have = {f.name: f.dataType.simpleString() for f in batch.schema}
    if want != have:
        wrong = sorted(n for n in {*want, *have} if want.get(n) != have.get(n))
        raise ValueError(f"columns differ from the stored table's: {wrong}")


def last_per_key(batch: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the largest by `order_by`, ties by the remaining columns.

    An aggregate rather than a ranking window: it combines map-side, so a key that holds a
    large part of the batch is not gathered into one task.
    """
    rest = [c for c in batch.columns if c not in (*key, *order_by)]
    ranked = F.struct(*order_by, *rest)
    if not order_by and not rest:
        return batch.select(*key).distinct().select(*batch.columns)
    picked = batch.groupBy(*key).agg(F.max(ranked).alias("_row"))
    return picked.select(*key, "_row.*").select(*batch.columns)


def merge_by_key(current: DataFrame, latest: DataFrame, key: Sequence[str]) -> DataFrame:
    """`current` without the keys of `latest`, plus `latest` (one row per key)."""
    keys = latest.select(*(F.col(k).alias(f"_new_{k}") for k in key))
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in key]
    return current.join(keys, same, "left_anti").unionByName(latest)
