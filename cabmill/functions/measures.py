"""Additive partial measures of trips, and the totals and means read from them.

A partial row holds, for one combination of keys, sums and counts that add up under further
grouping. An amount, distance or duration is added in two parts: its whole number of fixed-point
units as an integer, and what is left of it as a double. The first is exact and does not depend
on the order in which partitions are merged; for data of the declared scale the second is zero,
so a re-run of an interval gives the same bits. Values of a finer scale, NaN and amounts beyond
the range of the units are in the second part: nothing is cut, nothing overflows, and `rest_*`
counts them. True ratios (speed, per-mile, ...) have no fixed scale and are summed as doubles.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabmill import schemas as S

# Declared scale of amounts and distances; the sources carry hundredths.
AMOUNT_SCALE = 4
# Timestamps are exact to the microsecond, and durations are minutes.
_MICROSECONDS_PER_MINUTE = 60_000_000
# Units of one value that are added as an integer: a group may hold nine million such values.
_MOST_UNITS = 10**12


@dataclass(frozen=True)
class Measure:
    column: str
    units: int | None = None  # fixed-point units per 1.0; None: summed as it is
    exact: bool = False  # always a whole number of units

    @property
    def _fits(self) -> str:
        return f"abs({self.column}) < {_MOST_UNITS / self.units!r}D"

    @property
    def value(self) -> str:
        """What is added exactly; NULL with the column."""
        if self.units is None:
            return self.column
        units = f"CAST(rint({self.column} * {self.units}) AS BIGINT)"
        if self.exact:
            return units
        return f"if({self.column} IS NULL OR {self._fits}, {units}, 0)"

    @property
    def rest(self) -> str | None:
        """What is left of the value; NULL where that is nothing."""
        if self.units is None or self.exact:
            return None
        left = f"{self.column} - rint({self.column} * {self.units}) / {self.units}D"
        return f"if({self._fits}, nullif({left}, 0D), {self.column})"


def _amount(column: str) -> Measure:
    return Measure(column, 10**AMOUNT_SCALE)


MEASURES = {
    "passengers": Measure("passenger_count"),
    "distance": _amount("trip_distance"),
    "fare": _amount("fare_amount"),
    "tip": _amount("tip_amount"),
    "total": _amount("total_amount"),
    "extra": _amount("extra"),
    "tolls": _amount("tolls_amount"),
    "duration": Measure("trip_duration_minutes", _MICROSECONDS_PER_MINUTE, exact=True),
    "speed": Measure("avg_speed_mph"),
    "fare_per_mile": Measure("fare_per_mile"),
    "tip_ratio": Measure("tip_percentage"),
    "per_minute": Measure("revenue_per_minute"),
}
CONDITIONS = {
    "tipped": "tip_amount > 0",
    "high_tip": "is_high_tip",
    "card": f"payment_type_key = {S.CREDIT_CARD}",
    "cash": f"payment_type_key = {S.CASH}",
    "standard_rate": f"rate_code_key = {S.STANDARD_RATE}",
    "jfk": f"rate_code_key = {S.JFK_RATE}",
    "airport": "is_airport_trip",
    "rush_hour": "is_rush_hour",
    "weekend": "is_weekend",
    "short": "distance_category = 'Short'",
    "medium": "distance_category = 'Medium'",
    "long": "distance_category = 'Long'",
}


def partials(
    fact: DataFrame,
    keys: Iterable[str],
    measures: Iterable[str] = tuple(MEASURES),
    conditions: Iterable[str] = tuple(CONDITIONS),
) -> DataFrame:
    """One pass over the trips down to one partial row per combination of keys.

    The sums combine map-side: what is shuffled is at most one row per task and combination,
    however many trips one key holds.
    """
    columns = ["count(1) AS trips"]
    for name in measures:
        measure = MEASURES[name]
        columns.append(f"sum({measure.value}) AS sum_{name}")
        columns.append(f"count({measure.column}) AS n_{name}")
        if measure.rest:
            columns.append(f"sum({measure.rest}) AS left_{name}")
            columns.append(f"count({measure.rest}) AS rest_{name}")
        if name == "distance":
            columns.append(f"min({measure.column}) AS min_distance")
            columns.append(f"max({measure.column}) AS max_distance")
    columns += [f"count_if({CONDITIONS[name]}) AS if_{name}" for name in conditions]
    return fact.groupBy(*keys).agg(*map(F.expr, columns))


def roll_up(parts: DataFrame, keys: Iterable[str], *extra: Column) -> DataFrame:
    """Partial rows at a coarser grain; `extra` aggregates are added as they are.

    Partial rows are unique by their own keys, so at that grain there is nothing to add up.
    """
    merges = {c: _merge(c) for c in parts.columns if _merge(c)}
    if not extra and set(parts.columns) - set(merges) == set(keys):
        return parts
    merged = (F.expr(f"{merge}({column}) AS {column}") for column, merge in merges.items())
    return parts.groupBy(*keys).agg(*merged, *extra)


def _merge(column: str) -> str | None:
    """The aggregate that merges a partial column; None for a key."""
    if column.startswith(("min_", "max_")):
        return column[:3]
    summed = column == "trips" or column.startswith(("sum_", "left_", "rest_", "n_", "if_"))
    return "sum" if summed else None


def _sum(name: str) -> str:
    """The total as a double, in the measure's own unit."""
    measure = MEASURES[name]
    if measure.units is None:
        return f"sum_{name}"
    if measure.exact:  # whole microseconds, to seconds, to minutes
        return f"CAST(sum_{name} AS DOUBLE) / 1000000D / 60D"
    return f"(sum_{name} / {measure.units}D + coalesce(left_{name}, 0D))"


def total(name: str, alias: str) -> str:
    return f"{_sum(name)} AS {alias}"


def mean(name: str, alias: str) -> str:
    """Mean over the rows that have the value; NULL when none has."""
    return f"CAST({_sum(name)} AS DOUBLE) / nullif(n_{name}, 0) AS {alias}"


def percent(part: str, whole: str, alias: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100 / CAST({whole} AS DOUBLE) AS {alias}"


# -- distinct counts that add up ---------------------------------------------------------------


def distinct_cells(rows: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """Which values occur per combination of keys: (keys, column_name, bucket, bitmap).

    A bitmap marks the whole numbers of one bucket of 32768. Bitmaps of equal buckets are merged
    by OR, so distinct counts over any union of cells come from the cells alone. NULL is no value.
    """
    keys, columns = list(keys), list(columns)
    pairs = ", ".join(f"'{c}', CAST({c} AS BIGINT)" for c in columns)
    values = rows.selectExpr(*keys, f"stack({len(columns)}, {pairs}) AS (column_name, value)")
    return values.where("value IS NOT NULL").groupBy(
        *keys, "column_name", F.bitmap_bucket_number("value").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bitmap"))


def distinct_counts(cells: DataFrame, keys: Iterable[str]) -> DataFrame:
    """(keys, column_name, distinct_values): distinct values over coarser keys of such cells."""
    keys = list(keys)
    merged = cells.groupBy(*keys, "column_name", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys, "column_name").agg(F.sum(F.bitmap_count("bitmap")).alias("distinct_values"))
