"""Row-level models: raw tables -> base -> cleaned -> enriched -> fact.

All four are narrow (no shuffle): a union, filters and projections, one codegen stage.
"""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame

from cabmill import schemas as S
from cabmill.functions import expressions as X

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
#: Layout of the trips of a day: close on the curve is close on the map.
PICKUP_CURVE = X.on_curve({"pickup_latitude": S.LATITUDE_BOX, "pickup_longitude": S.LONGITUDE_BOX})


def base_trip(
    *raw: DataFrame, start: date | None = None, end: date | None = None, mode: str = "half_open"
) -> DataFrame:
    """All raw tables as one; duplicates are kept. With an interval, its days only; without,
    the whole history."""
    trips = reduce(DataFrame.unionByName, (r.select(*S.RAW_COLUMNS) for r in raw))
    if start is None and end is None:
        return trips
    return trips.where(X.time_window(PICKUP, start, end, mode))


def cleaned_trip(base: DataFrame) -> DataFrame:
    return base.where(X.is_valid_trip())


def enriched_trip(cleaned: DataFrame) -> DataFrame:
    # The duration and the hour are computed once and referred to by name after that.
    timed = cleaned.selectExpr(
        *S.RAW_COLUMNS,
        f"CAST({PICKUP} AS DATE) AS pickup_date",
        f"hour({PICKUP}) AS pickup_hour",
        f"{X.seconds_between(PICKUP, DROPOFF)} AS _seconds",
    )
    return timed.selectExpr(
        *S.RAW_COLUMNS,
        "pickup_date",
        "pickup_hour",
        "_seconds / 60 AS trip_duration_minutes",
        f"{X.guarded_ratio('trip_distance', '_seconds / 3600')} AS avg_speed_mph",
        f"{X.guarded_ratio('fare_amount', 'trip_distance')} AS fare_per_mile",
        f"{X.guarded_ratio('tip_amount', 'fare_amount')} AS tip_percentage",
        f"{X.guarded_ratio('total_amount', '_seconds / 60')} AS revenue_per_minute",
        f"{X.banded('trip_distance', S.DISTANCE_BANDS)} AS distance_category",
        f"{X.banded('_seconds / 60', S.DURATION_BANDS)} AS duration_category",
        f"{X.day_part('pickup_hour')} AS time_of_day",
        f"{X.is_rush_hour('pickup_hour')} AS is_rush_hour",
        f"{X.is_weekend('pickup_date')} AS is_weekend",
        f"{X.is_airport_rate('ratecodeid')} AS is_airport_trip",
        f"{X.is_high_tip('payment_type', 'tip_amount', 'fare_amount')} AS is_high_tip",
    )


_KEY_NAMES = {
    "pickup_date": "date_key",
    "pickup_hour": "time_key",
    "vendorid": "vendor_key",
    "payment_type": "payment_type_key",
    "ratecodeid": "rate_code_key",
    PICKUP: "pickup_datetime",
    DROPOFF: "dropoff_datetime",
}


def fact_trip(enriched: DataFrame) -> DataFrame:
    """One row per trip: the enriched columns under their star-schema names.

    The day part belongs to the hour dimension, so it leaves; a surrogate key joins.
    """
    key = X.trip_key(PICKUP, "vendorid", "pickup_latitude", "pickup_longitude")
    kept = [c for c in enriched.columns if c != "time_of_day"]
    return enriched.selectExpr(
        f"{key} AS trip_key", *(f"{c} AS {_KEY_NAMES.get(c, c)}" for c in kept)
    )
