"""Declared schemas and the fixed code lists of the trip domain."""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The source contract. All columns are nullable: raw files do contain missing values.
RAW_TRIP = StructType(
    [
        StructField("vendorid", LongType()),
        StructField("tpep_pickup_datetime", TimestampNTZType()),
        StructField("tpep_dropoff_datetime", TimestampNTZType()),
        StructField("passenger_count", LongType()),
        StructField("trip_distance", DoubleType()),
        StructField("pickup_longitude", DoubleType()),
        StructField("pickup_latitude", DoubleType()),
        StructField("ratecodeid", LongType()),
        StructField("store_and_fwd_flag", StringType()),
        StructField("dropoff_longitude", DoubleType()),
        StructField("dropoff_latitude", DoubleType()),
        StructField("payment_type", LongType()),
        StructField("fare_amount", DoubleType()),
        StructField("extra", DoubleType()),
        StructField("mta_tax", DoubleType()),
        StructField("tip_amount", DoubleType()),
        StructField("tolls_amount", DoubleType()),
        StructField("improvement_surcharge", DoubleType()),
        StructField("total_amount", DoubleType()),
    ]
)
RAW_COLUMNS = RAW_TRIP.fieldNames()

# Code lists of the source system. Codes not listed read as UNKNOWN_LABEL.
UNKNOWN_LABEL = "Unknown"
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc",
}
PAYMENT_TYPE_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
RATE_CODE_NAMES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
CREDIT_CARD, CASH = 1, 2
STANDARD_RATE, JFK_RATE, NEWARK_RATE = 1, 2, 3

# Validity limits of a trip, (exclusive, exclusive).
DISTANCE_LIMITS = (0, 100)
FARE_LIMITS = (0, 500)
TOTAL_LIMITS = (0, 1000)
MAX_PASSENGERS = 6
# Pickup bounding box, (inclusive, inclusive).
LATITUDE_BOX = (40.5, 41.0)
LONGITUDE_BOX = (-74.5, -73.5)

# Fixed values: (inclusive upper bound, label), then the label above the last bound.
DISTANCE_BANDS = ((1, "Short"), (5, "Medium"), (10, "Long"))
DURATION_BANDS = ((10, "Quick"), (30, "Normal"), (60, "Long"))
TOP_BAND = "Very Long"
# Fixed values: (first hour, last hour, label), both inclusive; other hours are NIGHT.
DAY_PARTS = ((6, 11, "Morning"), (12, 17, "Afternoon"), (18, 21, "Evening"))
NIGHT = "Night"
RUSH_HOURS = ((7, 9), (17, 19))
HIGH_TIP_RATIO = 0.20
