"""Ad-hoc queries: counts, previews, table profile, window functions over whole tables."""

import math
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from cabmill.sources.shared import Scratch, short_methods, written


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("row_count"))


def average_of(table: DataFrame, column: str, alias: str) -> DataFrame:
    return table.agg(F.avg(column).alias(alias))


def rows_per_day(table: DataFrame, time_column: str) -> DataFrame:
    """date_trunc('day', ...) with counts. Spark's own `date_trunc` leaves the zone-free type."""
    day = F.to_date(time_column).cast("timestamp_ntz").alias("day")
    return table.groupBy(day).agg(F.count(F.lit(1)).alias("row_count")).orderBy("day")


def head(table: DataFrame, order_by: Sequence[str], rows: int) -> DataFrame:
    """The first rows in a fixed order: a top-k per task, then one merge of k rows each."""
    return table.orderBy(*order_by).limit(rows)


def with_group_size(table: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """count(*) OVER (PARTITION BY keys), without gathering a group into one task.

    The counts are aggregated map-side, written, and joined back. Their size is then known:
    Spark broadcasts them below its threshold and leaves the rows where they are; above it,
    it shuffles, and its skew handling splits a key with many rows.
    """
    counted = table.groupBy(*(F.col(k).alias(f"_group_{k}") for k in keys)).agg(
        F.count(F.lit(1)).alias(alias)
    )
    counted = written(counted, "group-size")
    same = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys]
    return table.join(counted, same).select(*table.columns, alias)


_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_row_number(table: DataFrame, order_by: Sequence[str], alias: str) -> DataFrame:
    """row_number() OVER (ORDER BY ...) without sorting everything in one task.

    The rows are range-sorted over all tasks, which number their own rows; a partition's
    numbers are then shifted by the row counts of the partitions before it. The sorted rows
    are written once, as the range bounds come from a sample and must not be drawn twice.
    `order_by` should end in a unique column: it fixes the result, and lets the range sort
    split a run of equal leading values.
    """
    ordered = table.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id())
    ordered = written(ordered, "row-number")
    part = F.shiftright("_id", _LOCAL_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition; written, so that its small size is known and no row is shuffled.
    offsets = written(_exclusive_sums(sizes, "_size", ["_part"]), "offsets")
    local = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        ordered.withColumn("_part", part)
        .join(offsets, "_part")
        .select(*table.columns, (F.col("_offset") + local + 1).alias(alias))
    )


def _exclusive_sums(
    sizes: DataFrame, size: str, order_by: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Adds `_offset`, the sum of `size` over the rows before. One row per partition."""
    before = (
        Window.partitionBy(*within)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.withColumn("_offset", F.coalesce(F.sum(size).over(before), F.lit(0)))


# -- table profile -----------------------------------------------------------------------------

QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}
_POINTS = ["min", *QUARTILES, "max"]
# Size of a quantile sketch, and the share of the values around a quartile that its bracket takes
# on either side: three times the error that a sketch of this size exceeds once in a hundred times.
_SKETCH, _MARGIN = 2000, 0.0045
# Without a second scan the sketch itself answers, so it is larger.
_FINE_SKETCH = 16_000
# Tasks whose partial results meet first, so that no task merges those of all; rows of a chunk.
_TASKS_TOGETHER, _CHUNK = 64, 1 << 18
# Bits of a count within a chunk.
_PACKED = 20
# Bits of a digit of a time, whose digits are added apart: a sum of 2^41 of them is a BIGINT.
_DIGIT = 22
_PROFILE = (
    "column_name string, count long, null_count long, mean double, std double, "
    + "".join(f"{p} double, " for p in _POINTS)
    + "".join(f"{p}_ts timestamp_ntz, " for p in ["mean", *_POINTS])
    + "min_text string, max_text string"
)


def profile(table: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: count, nulls, mean, deviation, extremes and quartiles.

    Numbers fill `mean` .. `max`; dates and timestamps the `*_ts` columns (no deviation; an
    instant as its UTC time); text, flags and binaries (in hexadecimal) `min_text` and `max_text`,
    and `mean` of a flag is the share of true. Any other type is counted. Quartiles are discrete:
    the smallest value that at least the given share of the values does not exceed; NaN is the
    largest number.

    The table is scanned twice, whatever its values. The first scan gives the simple statistics
    and a quantile sketch per column, hence a narrow bracket around each quartile. The second
    adds the squared deviations from the means, counts what lies before, between and at the ends of the brackets, and keeps the values strictly
    inside, about one in a hundred; however many rows share a value, it is then at an end or rare.
    The quartiles are ends, or are found among the kept values, which are sorted over all tasks.
    `exact=False` takes them from a larger sketch, in one scan.
    """
    columns = [_Profiled(i, f.name, _family(f.dataType), exact) for i, f in enumerate(table.schema)]
    with short_methods(table.sparkSession), Scratch(table.sparkSession, "profile") as scratch:
        rows, sketches = _first_scan(scratch, table, columns, _SKETCH if exact else _FINE_SKETCH)
        margin = _MARGIN if exact else 0.0
        _bracketed(sketches, columns, margin)
        while exact and (missed := _second_scan(scratch, table, columns)):
            # A sketch was off by more than three times its error: wider brackets, one scan more.
            margin *= 4
            _bracketed(sketches, missed, margin)
    return table.sparkSession.createDataFrame([c.row(rows) for c in columns], _PROFILE)


def _family(data_type) -> str:
    if isinstance(data_type, (DoubleType, FloatType, DecimalType)):
        return "real"
    if isinstance(data_type, IntegralType):
        return "whole"
    if isinstance(data_type, (TimestampNTZType, DateType)):
        return "time"
    if isinstance(data_type, TimestampType):
        return "instant"
    if isinstance(data_type, (StringType, BooleanType, BinaryType)):
        return {"string": "text", "boolean": "flag"}.get(data_type.typeName(), "bytes")
    return "other"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value) -> str:
    return f"{value}L" if isinstance(value, int) else f"double('{value!r}')"


class _Profiled:
    """One column: its aggregates, what they gave, and the brackets of its quartiles."""

    def __init__(self, position: int, name: str, family: str, exact: bool):
        self.position, self.name, self.family, self.exact = position, name, family, exact
        self.mean: float | None = None
        self.squares: float | None = None  # sum of the squared deviations from it
        self.wanted: dict[str, int] = {}  # quartile: rank, until it is found
        self.found: dict[str, int | float] = {}
        self.brackets: list[tuple] = []  # disjoint (low, high), ascending

    @property
    def value(self) -> str | None:
        """Numbers and times (as microseconds) as BIGINT or DOUBLE."""
        column = _quoted(self.name)
        if self.family == "time":
            # Days, and within the day an interval a million times as long, in whole seconds:
            # no decimals, and no session time zone.
            ts = f"CAST({column} AS TIMESTAMP_NTZ)"
            of_day = f"({ts} - CAST(CAST({ts} AS DATE) AS TIMESTAMP_NTZ)) * 1000000"
            micros = f"CAST(CAST({of_day} AS INTERVAL SECOND) AS BIGINT)"
            return f"unix_date(CAST({ts} AS DATE)) * 86400000000L + {micros}"
        return {
            "whole": f"CAST({column} AS BIGINT)",
            "real": f"CAST({column} AS DOUBLE)",
            "instant": f"unix_micros({column})",
        }.get(self.family)

    @property
    def text(self) -> str | None:
        column = f"v{self.position}"
        return {"text": column, "flag": f"CAST({column} AS STRING)", "bytes": f"hex({column})"}.get(
            self.family
        )

    @property
    def sketch(self) -> str:
        return "double" if self.family == "real" else "bigint"

    def partial(self, k: int) -> dict[str, tuple[str, str]]:
        """Aggregate over rows, and the aggregate that merges its results."""
        column = f"v{self.position}"
        v = self.value and column
        out = {"count": (f"count({column})", "coalesce(sum({}), 0)")}
        if self.text:
            out |= {p: (f"{p}({self.text})", f"{p}({{}})") for p in ("min", "max")}
        if self.family == "flag":
            out["sum"] = (f"sum(CAST({column} AS INT))", "sum({})")
        if v:
            out |= {p: (f"{p}({v})", f"{p}({{}})") for p in ("min", "max")}
            if self.family in ("real", "whole"):
                # Count and sum of a part, and its squared deviations if no second scan adds them.
                m2 = "CAST(NULL AS DOUBLE)" if self.exact else f"var_pop({v}) * count({v})"
                moments = f"struct(count({v}) AS n, sum(CAST({v} AS DOUBLE)) AS s, {m2} AS m2)"
                out["moments"] = (moments, "collect_list({})")
            out["sketch"] = (f"kll_sketch_agg_{self.sketch}({v}, {k})", f"kll_merge_agg_{self.sketch}({{}})")
            if self.family == "real":
                out["nans"] = (f"count_if(isnan({v}))", "sum({})")
            elif self.family != "whole":
                low = f"{(1 << _DIGIT) - 1}L"
                digits = f"{v} & {low}", f"shiftright({v}, {_DIGIT}) & {low}", f"shiftright({v}, {2 * _DIGIT})"
                out |= {f"digit{i}": (f"sum({d})", "sum({})") for i, d in enumerate(digits)}
        return out

    def take(self, row) -> None:
        self.got = {n: row[f"c{self.position}_{n}"] for n in self.partial(1) if n != "sketch"}
        count, nans = self.got["count"], self.got.get("nans") or 0
        self.numbers = count - nans
        if moments := [m for m in self.got.get("moments") or () if m.n]:
            self.mean = _mean(moments)
            if not self.exact:
                self.squares = sum(m.m2 + m.n * (m.s / m.n - self.mean) ** 2 for m in moments)
        if self.value and count:
            for name, share in QUARTILES.items():
                rank = math.ceil(share * count)
                if rank <= self.numbers:
                    self.wanted[name] = rank
                else:
                    self.found[name] = math.nan

    def shares(self, margin: float) -> list[float]:
        middle = (rank / self.numbers for rank in self.wanted.values())
        return [min(1.0, max(0.0, m + d)) for m in middle for d in (-margin, margin)]

    def bracket(self, points: list) -> None:
        self.brackets = []
        for low, high in sorted(zip(points[::2], points[1::2], strict=True)):
            if self.brackets and low <= self.brackets[-1][1]:
                low, before = self.brackets.pop()
                high = max(high, before)
            self.brackets.append((low, high))

    @property
    def zone(self) -> str:
        """Where a value lies: of bracket n, 4 n before it, 4 n + 1 at its low end, 4 n + 2 inside,
        4 n + 3 at its high end; NULL beyond the last bracket, for NULL and for NaN."""
        v = f"v{self.position}"
        whens = "".join(
            f" WHEN {v} < {_literal(low)} THEN {4 * n} WHEN {v} = {_literal(low)} THEN {4 * n + 1}"
            f" WHEN {v} < {_literal(high)} THEN {4 * n + 2} WHEN {v} = {_literal(high)} THEN {4 * n + 3}"
            for n, (low, high) in enumerate(self.brackets)
        )
        return f"CASE{whens} END AS z{self.position}"

    @property
    def zones(self) -> range:
        return range(4 * len(self.brackets))

    def counts(self) -> list[str]:
        """Per chunk of rows: the sizes of the zones, three to a number, as fewer aggregates cost
        less, the values inside of brackets, and the squared deviations."""
        z, out = f"z{self.position}", []
        for n in self.zones[::3]:
            whens = " ".join(f"WHEN {n + i} THEN {1 << i * _PACKED}L" for i in range(3))
            out.append(f"sum(CASE {z} {whens} ELSE 0L END) AS n{self.position}_{n}")
        if self.squares is None and self.mean is not None:
            off = f"(v{self.position} - {_literal(self.mean)})"
            out.append(f"sum({off} * {off}) AS s{self.position}")
        inside = f"if(pmod({z}, 4) = 2, v{self.position}, NULL)"
        return [*out, f"collect_list({inside}) AS i{self.position}"]

    def sizes(self) -> list[str]:
        """The sizes of the zones over all chunks."""
        size = "shiftright(n{0}_{1}, {2}) & {3}L".format
        return [
            f"coalesce(sum({size(self.position, k // 3 * 3, k % 3 * _PACKED, (1 << _PACKED) - 1)}), 0)"
            f" AS n{self.position}_{k}"
            for k in self.zones
        ]

    def settle(self, sizes: list[int]) -> list[tuple[str, int]]:
        """Take the quartiles that lie at the end of a bracket; gives for those inside of one
        their place among all values inside of brackets."""
        places = []
        for name, rank in list(self.wanted.items()):
            before = inside = 0
            for k, size in enumerate(sizes):
                if rank <= before + size:
                    if k % 4 == 2:
                        places.append((name, inside + rank - before))
                    elif k % 4:
                        self.found[name] = self.brackets[k // 4][k % 4 // 2]
                        del self.wanted[name]
                    break
                before += size
                inside += size if k % 4 == 2 else 0
        return places

    def deviation(self) -> float:
        if not math.isfinite(self.mean):
            return math.nan
        if self.got["min"] == self.got["max"]:
            return 0.0
        return math.sqrt(self.squares / (self.got["count"] - 1))

    def row(self, rows: int) -> tuple:
        got, points = self.got, dict.fromkeys(_POINTS)
        mean, std = self.mean, None
        if self.value:
            points |= {"min": got["min"], "max": got["max"]} | self.found
            if mean is not None and got["count"] > 1:
                std = self.deviation()
        elif self.family == "flag" and got["count"]:
            mean = got["sum"] / got["count"]
        moment = self.family in ("time", "instant")
        at = lambda micros: None if micros is None else _SINCE + timedelta(microseconds=micros)
        number = lambda x: None if moment or x is None else float(x)
        middle = None
        if moment and got["count"]:
            total = sum(got[f"digit{i}"] << i * _DIGIT for i in range(3))
            middle = _truncated(total, got["count"])
        return (
            self.name, got["count"], rows - got["count"], number(mean), number(std),
            *(number(points[p]) for p in _POINTS),
            at(middle), *(at(points[p]) if moment else None for p in _POINTS),
            got.get("min") if self.text else None, got.get("max") if self.text else None,
        )


_SINCE = datetime(1970, 1, 1)


def _truncated(total: int, count: int) -> int:
    """The quotient without its fraction, as SQL divides whole numbers."""
    return total // count if total >= 0 else -(-total // count)


def _mean(moments: list) -> float:
    """Of the union of some parts, from their counts and sums."""
    sums = [m.s for m in moments]
    return (math.fsum(sums) if all(map(math.isfinite, sums)) else sum(sums)) / sum(m.n for m in moments)


def _values(table: DataFrame, columns: list[_Profiled]) -> DataFrame:
    """The columns under their numbers, numbers and times as BIGINT or DOUBLE, computed once."""
    return table.selectExpr(*(f"{c.value or _quoted(c.name)} AS v{c.position}" for c in columns))


def _first_scan(
    scratch: Scratch, table: DataFrame, columns: list[_Profiled], k: int
) -> tuple[int, DataFrame]:
    """Simple statistics of all columns; gives the number of rows and a row of sketches."""
    each = [(f"c{c.position}_{n}", *e) for c in columns for n, e in c.partial(k).items()]
    group = F.floor(F.spark_partition_id() / _TASKS_TOGETHER).alias("part")
    parts = _values(table, columns).groupBy(group).agg(
        F.expr("count(1) AS rows"), *(F.expr(f"{e} AS {name}") for name, e, _ in each)
    )
    parts = scratch.written(parts)
    merged = [F.expr(f"{merge.format(name)} AS {name}") for name, _, merge in each]
    whole = scratch.written(parts.agg(F.expr("coalesce(sum(rows), 0) AS rows"), *merged))
    sketches = [name for name, *_ in each if name.endswith("_sketch")]
    row = whole.drop(*sketches).first()
    for c in columns:
        c.take(row)
    return row["rows"], whole.select(*sketches)


def _bracketed(sketches: DataFrame, columns: list[_Profiled], margin: float) -> None:
    """Brackets of the quartiles still wanted, from the sketches; without a margin, the answers."""
    some = [c for c in columns if c.wanted]
    if not some:
        return
    row = sketches.selectExpr(*(
        f"kll_sketch_get_quantile_{c.sketch}(c{c.position}_sketch,"
        f" array({', '.join(f'{s!r}D' for s in c.shares(margin))})) AS c{c.position}"
        for c in some
    )).first()
    for c in some:
        points = row[f"c{c.position}"]
        if margin:
            c.bracket(points)
        else:
            c.found |= dict(zip(c.wanted, points[::2], strict=True))


def _second_scan(scratch: Scratch, table: DataFrame, columns: list[_Profiled]) -> list[_Profiled]:
    """Find the quartiles that are wanted; gives the columns with one outside of its bracket.

    Rows are counted in chunks, so that what a chunk collects is bounded: a value strictly inside
    of a bracket takes part of the bracket's share of all ranks, ties or not.
    """
    some = {c.position: c for c in columns if c.wanted}
    if not some:
        return []
    chunk = F.floor(F.monotonically_increasing_id() / _CHUNK).alias("chunk")
    zoned = _values(table, list(some.values())).selectExpr("*", *(c.zone for c in some.values()))
    chunks = scratch.written(
        zoned.groupBy(chunk).agg(*(F.expr(e) for c in some.values() for e in c.counts()))
    )
    squares = [n for n in chunks.columns if n.startswith("s")]
    sums = [F.sum(n).alias(n) for n in squares]
    sizes = chunks.agg(*(F.expr(e) for c in some.values() for e in c.sizes()), *sums).first()
    for n in squares:
        some[int(n[1:])].squares = sizes[n]
    places = [
        (p, *place) for p, c in some.items() for place in c.settle([sizes[f"n{p}_{k}"] for k in c.zones])
    ]
    if places:
        for position, name, value in _ranked(scratch, chunks, some, places):
            some[position].found[name] = value
            del some[position].wanted[name]
    return [c for c in some.values() if c.wanted]


def _ranked(
    scratch: Scratch, chunks: DataFrame, columns: dict[int, _Profiled], places: list[tuple[int, str, int]]
) -> list[tuple[int, str, int | float]]:
    """The values at some places among the collected ones of a column, which are counted and sorted
    over all tasks; only the partitions that hold a place are looked at."""
    kinds = {"w": "bigint", "r": "double"}
    lists = []
    for name, kind in kinds.items():
        own = [p for p, c in columns.items() if c.sketch == kind]
        if own:
            stacked = f"stack({len(own)}, {', '.join(f'{p}, i{p}' for p in own)}) AS (c, xs)"
            lists.append(chunks.selectExpr(stacked).selectExpr("c", f"explode(xs) AS {name}"))
    values = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists)
    by = ["c", *(n for n in kinds if n in values.columns)]
    ordered = scratch.written(
        values.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(*by)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", _LOCAL_BITS)
    # One row per partition, and one more for each column that begins inside of one.
    sizes = ordered.groupBy("c", part.alias("part")).agg(F.sum("n").alias("n")).orderBy("c", "part")
    upto: dict[int, list] = {}
    for r in sizes.collect():
        own = upto.setdefault(r.c, [])
        own.append((r.part, r.n, sum(own[-1][1:]) if own else 0))
    targets = []
    for position, name, place in places:
        at, _, before = next(x for x in upto[position] if place <= x[1] + x[2])
        targets.append((position, name, at, place - before))
    wanted = chunks.sparkSession.createDataFrame(targets, "c int, name string, part long, place long")
    within = Window.partitionBy("c", "part").orderBy("_id")
    held = ordered.withColumn("part", part).where(F.col("part").isin([t[2] for t in targets]))
    running = held.withColumn("upto", F.sum("n").over(within))
    hits = running.join(wanted, ["c", "part"]).where("upto >= place AND upto - n < place")
    value = lambda r: r.w if "w" in by and r.w is not None else r.r
    return [(r.c, r.name, value(r)) for r in hits.collect()]
