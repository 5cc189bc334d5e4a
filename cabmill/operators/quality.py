"""Data contracts: source schema, output shape, star-schema keys, surrogate key."""

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabmill.sources.shared import written

# Foreign key of the fact table and the dimension that holds it.
STAR_KEYS = {
    "date_key": "dim_date",
    "time_key": "dim_time",
    "vendor_key": "dim_vendor",
    "payment_type_key": "dim_payment_type",
    "rate_code_key": "dim_rate_code",
}


def contract_violations(actual: StructType, declared: StructType) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) where they differ; '' for a column not there."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in declared}
    return [
        (name, want.get(name, ""), have.get(name, ""))
        for name in [*want, *(n for n in have if n not in want)]
        if want.get(name) != have.get(name)
    ]


def contract_report(frame: DataFrame, declared: StructType) -> DataFrame:
    """One row per declared or present column: types, status and how many values it holds.

    One pass over the data, reading only the footers and definition levels it must.
    """
    have = {f.name: f.dataType.simpleString() for f in frame.schema}
    want = {f.name: f.dataType.simpleString() for f in declared}
    names = [*want, *(n for n in have if n not in want)]

    def status(name):
        if name not in have:
            return "missing"
        if name not in want:
            return "extra"
        return "ok" if have[name] == want[name] else "type_mismatch"

    counts = frame.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(n).alias(f"_n{i}") for i, n in enumerate(names) if n in have),
    )

    def line(i, name):
        values = f"_n{i}" if name in have else "CAST(0 AS BIGINT)"
        expected, actual = want.get(name, ""), have.get(name, "")
        return f"'{name}', '{expected}', '{actual}', '{status(name)}', {values}, _rows - {values}"

    lines = ", ".join(line(i, n) for i, n in enumerate(names))
    return counts.selectExpr(
        f"stack({len(names)}, {lines}) AS"
        " (column_name, expected_type, actual_type, status, value_count, null_count)"
    )


def shape_problems(columns: Sequence[str]) -> list[str]:
    """Per column what keeps a table from holding it: 'duplicate', 'unnamed', or '' for nothing."""
    counts = Counter(c.lower() for c in columns)
    named = lambda c: c.replace("_", "").isalnum() and not c[0].isdigit()
    return ["duplicate" if counts[c.lower()] > 1 else "" if named(c) else "unnamed" for c in columns]


def check_output_shape(columns: Sequence[str]) -> None:
    """Refuse projections that a table cannot hold: duplicate, unnamed or starred columns."""
    found = list(zip(shape_problems(columns), columns, strict=True))
    duplicates = sorted({c.lower() for problem, c in found if problem == "duplicate"})
    if duplicates:
        raise ValueError(f"duplicate output columns: {duplicates}")
    unnamed = [c for problem, c in found if problem == "unnamed"]
    if unnamed:
        raise ValueError(f"unnamed or unexpanded output columns: {unnamed}")


def shape_report(frame: DataFrame) -> DataFrame:
    """One row per output column: (position, column_name, problem, row_count), with the rows that a
    table of the projection would hold."""
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    lines = ", ".join(
        f"{i}, {text(name)}, '{problem}', _rows"
        for i, (name, problem) in enumerate(zip(frame.columns, shape_problems(frame.columns), strict=True), 1)
    )
    return frame.agg(F.count(F.lit(1)).alias("_rows")).selectExpr(
        f"stack({len(frame.columns)}, {lines}) AS (position, column_name, problem, row_count)"
    )


def key_values(combinations: DataFrame) -> DataFrame:
    """Every foreign-key value with its row count, (key, value, trips), from the key
    combinations of the fact table and their trips."""
    pairs = ", ".join(f"'{k}', CAST({k} AS STRING)" for k in STAR_KEYS)
    unpivoted = combinations.selectExpr(
        f"stack({len(STAR_KEYS)}, {pairs}) AS (key, value)", "trips"
    )
    return unpivoted.groupBy("key", "value").agg(F.sum("trips").alias("trips"))


def star_key_audit(combinations: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: trips whose key is NULL, and trips whose key its dimension lacks.

    `combinations` holds the five keys of the fact table and, in `trips`, how often they occur;
    a frame without these columns, such as the fact table itself, is refused.
    """
    if missing := {*STAR_KEYS, "trips"} - set(combinations.columns):
        raise ValueError(f"key combinations lack the columns {sorted(missing)}")
    known = reduce(
        DataFrame.unionByName,
        (
            dims[dim].select(
                F.lit(key).alias("key"), F.col(key).cast("string").alias("value")
            )
            for key, dim in STAR_KEYS.items()
        ),
    ).withColumn("known", F.lit(True))
    return (
        key_values(combinations)
        .join(known, ["key", "value"], "left")
        .groupBy("key")
        .agg(
            F.sum("trips").alias("trips"),
            F.expr("coalesce(sum(trips) FILTER (WHERE value IS NULL), 0)").alias("null_keys"),
            F.expr(
                "coalesce(sum(trips) FILTER (WHERE value IS NOT NULL AND known IS NULL), 0)"
            ).alias("orphan_keys"),
        )
    )


def trip_key_duplicates(fact: DataFrame) -> DataFrame:
    """One row: trips, distinct surrogate keys and surplus trips.

    The key is a hash, hence evenly spread; as sixteen bytes instead of hexadecimal text it
    shuffles at half the size.
    """
    keys = fact.groupBy(F.unhex("trip_key").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("trips"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_trips"),
    )


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur a different number of times, with `surplus` copies on the left.

    Both directions of EXCEPT ALL in one shuffle; equal rows cancel map-side where they meet.
    """
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionByName(
        right.select(*columns).withColumn("_sign", F.lit(-1))
    )
    surplus = signed.groupBy(*columns).agg(F.sum("_sign").alias("surplus"))
    return surplus.where("surplus <> 0")



def digests(table: DataFrame, cell: Sequence[Column]) -> DataFrame:
    """Per cell the number of rows and two sums of hashes of whole rows: the same for the same rows
    in any order, and combined map-side, so that no row is shuffled."""
    columns = sorted(table.columns)
    hashes = [F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)]
    return table.groupBy(*(c.alias(f"cell{i}") for i, c in enumerate(cell))).agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.sum(h.cast("decimal(38,0)")).alias(f"digest{i}") for i, h in enumerate(hashes)),
    )


def differing_cells(left: DataFrame, right: DataFrame, cell: Sequence[Column]) -> DataFrame:
    """The cells whose rows differ between two tables of the same columns."""
    names = [f"cell{i}" for i in range(len(cell))]
    measures = ["rows", "digest0", "digest1"]
    other = digests(right.select(*left.columns), cell).select(
        *(F.col(c).alias(f"other_{c}") for c in (*names, *measures))
    )
    same = lambda columns: reduce(
        lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in columns)
    )
    pairs = digests(left, cell).join(other, same(names), "full").where(~same(measures))
    return pairs.select(*(F.when(F.col("rows").isNull(), F.col(f"other_{c}")).otherwise(F.col(c)).alias(c) for c in names))


def table_difference_by_cell(left: DataFrame, right: DataFrame, time_column: str, buckets: int = 16) -> DataFrame:
    """`table_difference`, shuffling only rows of cells that differ: a cell is a day and a bucket of
    the rows' hashes. Tables that agree shuffle none. Two different cells pass for equal when
    their counts and both of their 64-bit hash sums agree."""
    columns = sorted(left.columns)
    cell = [F.col(time_column).cast("date"), F.pmod(F.xxhash64(F.lit("bucket"), *columns), F.lit(buckets)).cast("int")]
    cells = written(differing_cells(left, right, cell), "differing-cells")
    if cells.isEmpty():
        return left.limit(0).withColumn("surplus", F.lit(0).cast("long"))
    held = reduce(lambda a, b: a & b, (c.eqNullSafe(F.col(f"cell{i}")) for i, c in enumerate(cell)))
    return table_difference(
        left.join(cells, held, "left_semi"), right.select(*left.columns).join(cells, held, "left_semi")
    )
