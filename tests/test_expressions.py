"""Boundary rows of the row expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cabmill import schemas as S
from cabmill.functions import expressions as X
from cabmill.operators import dimensions, trips
from cabmill.schemas import RAW_TRIP

GOOD = {
    "vendorid": 1,
    "tpep_pickup_datetime": datetime(2015, 1, 5, 8, 0),
    "tpep_dropoff_datetime": datetime(2015, 1, 5, 8, 30),
    "passenger_count": 2,
    "trip_distance": 5.0,
    "pickup_longitude": -74.0,
    "pickup_latitude": 40.75,
    "ratecodeid": 1,
    "store_and_fwd_flag": "N",
    "dropoff_longitude": -73.9,
    "dropoff_latitude": 40.7,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 13.3,
}


def trip_rows(spark, *changes):
    rows = [{**GOOD, **c} for c in changes]
    return spark.createDataFrame([tuple(r[n] for n in RAW_TRIP.names) for r in rows], RAW_TRIP)


def values(spark, expression, column, kind, items):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, {column} {kind}")
    rows = frame.select("i", F.expr(expression).alias("r")).collect()
    return [r.r for r in sorted(rows)]


@pytest.mark.parametrize(
    "change, valid",
    [
        ({}, True),
        ({"tpep_dropoff_datetime": None}, False),
        ({"tpep_dropoff_datetime": GOOD["tpep_pickup_datetime"]}, False),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": 0.01}, True),
        ({"trip_distance": 99.99}, True),
        ({"trip_distance": 100.0}, False),
        ({"trip_distance": None}, False),
        ({"fare_amount": 0.0}, False),
        ({"fare_amount": 499.99}, True),
        ({"fare_amount": 500.0}, False),
        ({"total_amount": -1.0}, False),
        ({"total_amount": 1000.0}, False),
        ({"passenger_count": 0}, False),
        ({"passenger_count": 6}, True),
        ({"passenger_count": 7}, False),
        ({"passenger_count": None}, False),
        ({"pickup_latitude": 40.5}, True),
        ({"pickup_latitude": 41.0}, True),
        ({"pickup_latitude": 41.01}, False),
        ({"pickup_longitude": -74.5}, True),
        ({"pickup_longitude": -73.5}, True),
        ({"pickup_longitude": -73.49}, False),
        ({"dropoff_latitude": 0.0, "dropoff_longitude": 0.0}, True),
        ({"vendorid": None, "payment_type": None, "ratecodeid": None}, True),
    ],
)
def test_cleaning(spark, change, valid):
    assert trips.cleaned_trip(trip_rows(spark, change)).count() == int(valid)


def test_windows(spark):
    stamps = [
        datetime(2014, 12, 31, 23, 59, 59),
        datetime(2015, 1, 1),
        datetime(2015, 1, 31),
        datetime(2015, 1, 31, 0, 0, 1),
        datetime(2015, 1, 31, 23, 59, 59, 999999),
        datetime(2015, 2, 1),
    ]
    span = date(2015, 1, 1), date(2015, 1, 31)
    half_open = values(spark, X.time_window("t", *span), "t", "TIMESTAMP_NTZ", stamps)
    assert half_open == [False, True, True, True, True, False]
    literal = values(spark, X.time_window("t", *span, "literal"), "t", "TIMESTAMP_NTZ", stamps)
    assert literal == [False, True, True, False, False, False]
    with pytest.raises(ValueError):
        X.time_window("t", *span, "other")


def test_bands(spark):
    miles = [1.0, 1.01, 5.0, 5.01, 10.0, 10.01, None]
    assert values(spark, X.banded("d", S.DISTANCE_BANDS), "d", "DOUBLE", miles) == [
        "Short", "Medium", "Medium", "Long", "Long", "Very Long", "Very Long",
    ]
    minutes = [10.0, 10.1, 30.0, 60.0, 60.1]
    assert values(spark, X.banded("d", S.DURATION_BANDS), "d", "DOUBLE", minutes) == [
        "Quick", "Normal", "Normal", "Long", "Very Long",
    ]


def test_hours(spark):
    hours = [5, 6, 11, 12, 17, 18, 21, 22, None]
    assert values(spark, X.day_part("h"), "h", "INT", hours) == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night",
        "Night",
    ]
    hours = [6, 7, 9, 10, 16, 17, 19, 20, None]
    assert values(spark, X.is_rush_hour("h"), "h", "INT", hours) == [
        False, True, True, False, False, True, True, False, False,
    ]


def test_weekend_counts_from_sunday(spark):
    days = [date(2015, 1, d) for d in (3, 4, 5, 9)]  # Saturday, Sunday, Monday, Friday
    assert values(spark, X.day_of_week("d"), "d", "DATE", days) == [6, 0, 1, 5]
    assert values(spark, X.is_weekend("d"), "d", "DATE", days) == [True, True, False, False]


def test_enriched_guards_and_flags(spark):
    rows = trip_rows(
        spark,
        {},
        {"trip_distance": 0.0, "fare_amount": 0.0},
        {"tpep_dropoff_datetime": GOOD["tpep_pickup_datetime"]},
        {"tip_amount": 2.01, "ratecodeid": 2},
        {"tip_amount": 2.01, "payment_type": 2, "ratecodeid": None},
        {"tip_amount": None, "payment_type": None},
    )
    got = [r.asDict() for r in trips.enriched_trip(rows).collect()]
    assert len(got[0]) == 33
    first = got[0]
    assert first["trip_duration_minutes"] == 30.0 and first["avg_speed_mph"] == 10.0
    assert first["fare_per_mile"] == 2.0 and first["tip_percentage"] == 0.2
    assert first["revenue_per_minute"] == 13.3 / 30 and not first["is_high_tip"]
    assert got[1]["fare_per_mile"] == 0.0 and got[1]["tip_percentage"] == 0.0
    assert got[2]["avg_speed_mph"] == 0.0 and got[2]["revenue_per_minute"] == 0.0
    assert got[3]["is_high_tip"] and got[3]["is_airport_trip"]
    assert not got[4]["is_high_tip"] and got[4]["is_airport_trip"] is False
    assert got[5]["tip_percentage"] is None and got[5]["is_high_tip"] is False


def test_duration_ignores_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = trip_rows(
        spark,
        {
            "tpep_pickup_datetime": datetime(2015, 3, 8, 1, 59),  # 02:00-03:00 does not exist
            "tpep_dropoff_datetime": datetime(2015, 3, 8, 2, 30, 0, 500000),
        },
    )
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = trips.enriched_trip(rows).first()
        assert row.trip_duration_minutes == 1860.5 / 60
        assert row.pickup_hour == 1 and row.pickup_date == date(2015, 3, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_trip_key_skips_nulls(spark):
    rows = trips.fact_trip(trips.enriched_trip(trip_rows(spark, {}, {"vendorid": None})))
    assert len(rows.columns) == 33
    import hashlib

    want = [
        hashlib.md5(f"2015-01-05 08:00:00{v}40.75-74.0".encode()).hexdigest() for v in ("1", "")
    ]
    assert [r.trip_key for r in rows.collect()] == want


def test_labels_and_padded_names(spark):
    assert values(spark, X.label_of("c", S.VENDOR_NAMES), "c", "BIGINT", [1, 2, 3]) == [
        "Creative Mobile Technologies", "VeriFone Inc", "Unknown",
    ]
    enriched = trips.enriched_trip(
        trip_rows(
            spark,
            {
                "tpep_pickup_datetime": datetime(2016, 1, 1, 3),
                "tpep_dropoff_datetime": datetime(2016, 1, 1, 4),
                "payment_type": None,
            },
        )
    )
    day = dimensions.dim_date(enriched).first()
    assert (day.month_name, day.day_name) == ("January  ", "Friday   ")
    assert (day.week_of_year, day.year, day.day_of_year, day.quarter) == (53, 2016, 1, 1)
    assert dimensions.dim_payment_type(enriched).count() == 0


def test_on_curve(spark):
    rows = [(x, y) for x in (-1.0, 0.0, 1.0, 2.5, 4.0, 9.0, None, float("nan")) for y in (0.0, 1.0, 2.0, 3.0, 4.0)]
    table = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE")
    place = X.on_curve({"x": (0.0, 3.0), "y": (0.0, 3.0)}, bits=2)
    for r in table.selectExpr("*", f"{place} AS place").collect():
        steps = [0 if v is None or v != v else int(max(0, min(3, v))) for v in (r.x, r.y)]
        assert r.place == sum((s >> b & 1) << (2 * b + i) for i, s in enumerate(steps) for b in range(2))


def test_derived_trips_become_compilable_methods(spark, sf_dir, capsys):
    """The JVM never compiles a method of over 8000 bytes, which the filter's copies of the derived
    columns made of it."""
    import re

    from cabmill.registry import QUERIES

    for name in ("cleaned_trip", "enriched_trip", "fact_trip"):
        QUERIES[name](spark, sf_dir).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) <= 8000, (name, sizes)
