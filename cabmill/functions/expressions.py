"""Row expressions over trip columns, as SQL text for `selectExpr`, `where` and `expr`.

Arguments are column names or SQL expressions. Everything is built in, so it runs inside
generated code.
"""

from datetime import date, timedelta

from cabmill import schemas as S


def time_window(ts: str, start: date, end: date, mode: str = "half_open") -> str:
    """Rows of the days `start`..`end`, both included.

    `half_open` takes the whole last day. `literal` compares the timestamp with the bare
    end date, so the last day ends at its first midnight. Both are plain comparisons with
    constants, so they reach the parquet scan as pushed filters.
    """
    if mode == "half_open":
        return f"{ts} >= {_midnight(start)} AND {ts} < {_midnight(end + timedelta(days=1))}"
    if mode == "literal":
        return f"{ts} BETWEEN {_midnight(start)} AND {_midnight(end)}"
    raise ValueError(f"unknown time window mode: {mode}")


def _midnight(day: date) -> str:
    return f"TIMESTAMP_NTZ '{day.isoformat()} 00:00:00'"


def is_valid_trip() -> str:
    """Data-quality rules; a NULL in any tested column makes the row invalid."""

    def inside(column, limits):
        low, high = limits
        return f"{column} > {low} AND {column} < {high}"

    def within(column, box):
        low, high = box
        return f"{column} BETWEEN {low}D AND {high}D"

    rules = [  # tested in this order: number comparisons cost least
        inside("trip_distance", S.DISTANCE_LIMITS),
        inside("fare_amount", S.FARE_LIMITS),
        inside("total_amount", S.TOTAL_LIMITS),
        f"passenger_count > 0 AND passenger_count <= {S.MAX_PASSENGERS}",
        within("pickup_latitude", S.LATITUDE_BOX),
        within("pickup_longitude", S.LONGITUDE_BOX),
        "tpep_dropoff_datetime IS NOT NULL",
        "tpep_pickup_datetime < tpep_dropoff_datetime",
    ]
    return " AND ".join(rules)


def seconds_between(start: str, end: str) -> str:
    """Elapsed seconds of two zone-free timestamps, to the microsecond.

    The difference of the two is an interval. It does not pass through the session time zone,
    as `timestampdiff` does, so a daylight-saving gap cannot bend it.
    """
    return f"CAST(CAST(CAST({end} - {start} AS INTERVAL SECOND) AS DECIMAL(18, 6)) AS DOUBLE)"


def guarded_ratio(numerator: str, denominator: str) -> str:
    """numerator / denominator, and 0.0 unless the denominator is positive."""
    return f"CASE WHEN {denominator} > 0 THEN {numerator} / ({denominator}) ELSE 0D END"


def banded(value: str, bands) -> str:
    """Label of the first band whose upper bound holds the value."""
    whens = " ".join(f"WHEN {value} <= {bound} THEN '{label}'" for bound, label in bands)
    return f"CASE {whens} ELSE '{S.TOP_BAND}' END"


def day_part(hour: str) -> str:
    whens = " ".join(
        f"WHEN {hour} BETWEEN {low} AND {high} THEN '{label}'" for low, high, label in S.DAY_PARTS
    )
    return f"CASE {whens} ELSE '{S.NIGHT}' END"


def is_rush_hour(hour: str) -> str:
    tests = " OR ".join(f"{hour} BETWEEN {low} AND {high}" for low, high in S.RUSH_HOURS)
    return f"coalesce({tests}, false)"


def day_of_week(day: str) -> str:
    """0 = Sunday .. 6 = Saturday (Spark itself counts from 1)."""
    return f"dayofweek({day}) - 1"


def is_weekend(day: str) -> str:
    return f"coalesce({day_of_week(day)} IN (0, 6), false)"


def is_airport_rate(rate_code: str) -> str:
    return f"coalesce({rate_code} IN ({S.JFK_RATE}, {S.NEWARK_RATE}), false)"


def is_high_tip(payment_type: str, tip: str, fare: str) -> str:
    ratio = guarded_ratio(tip, fare)
    return f"coalesce({payment_type} = {S.CREDIT_CARD} AND {ratio} > {S.HIGH_TIP_RATIO}D, false)"


def label_of(code: str, names: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {value} THEN '{name}'" for value, name in names.items())
    return f"CASE {code} {whens} ELSE '{S.UNKNOWN_LABEL}' END"


def trip_key(pickup: str, vendor: str, latitude: str, longitude: str) -> str:
    """MD5 over the concatenated texts; NULL parts count as empty. Not unique by design."""
    parts = ", ".join(f"CAST({c} AS STRING)" for c in (pickup, vendor, latitude, longitude))
    return f"md5(concat_ws('', {parts}))"


def padded_name(day: str, pattern: str) -> str:
    """Full month or weekday name, blank-padded to nine characters."""
    return f"rpad(date_format({day}, '{pattern}'), 9, ' ')"


def on_curve(columns: dict[str, tuple[float, float]], bits: int = 10) -> str:
    """Place of a row on a Z-curve over some columns: each is cut into 2^bits equal steps between
    its limits (values beyond them count as the nearest step, NULL and NaN as the first), and the
    steps' bits are interleaved. Rows close on the curve are close in every column."""
    steps = (1 << bits) - 1
    places = []
    for low, high in columns.values():
        places.append((low, steps / (high - low)))
    terms = []
    for i, (column, (low, factor)) in enumerate(zip(columns, places, strict=True)):
        step = f"CAST(greatest(0D, least({steps}D, coalesce(nanvl(({column} - {low!r}D) * {factor!r}D, 0D), 0D))) AS BIGINT)"
        terms += [
            f"shiftleft(shiftright({step}, {b}) & 1L, {b * len(columns) + i})" for b in range(bits)
        ]
    return f"({' | '.join(terms)})"
