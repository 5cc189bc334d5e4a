"""Trip tables derived from a `lineitem` table, one trip per line item.

No taxi files come with the project, so the raw tables are computed from the given ones by
integer arithmetic; every amount is a whole number of hundredths divided by 100.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The second raw table takes over at this pickup date.
SECOND_TABLE_FROM = datetime(1998, 6, 1)


# Integer components of a trip, named for substitution into the columns below.
_TRIP = {
    "sod": "(l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 31) % 86400",
    "dur": "((l_partkey * 37 + l_orderkey) % 5400 - 120)",
    "dist": "(l_partkey * 53 + l_orderkey * 17) % 2500 + if(l_suppkey % 41 = 0, 10000, 0)",
    "lon": "(l_partkey % 120 - 7460)",
    "lat": "(l_orderkey % 60 + 4045)",
    "pay": "if(l_orderkey % 53 = 0, NULL, CAST(l_linenumber AS BIGINT))",
    "fare": "((l_partkey * 131 + l_orderkey * 29 + l_suppkey * 7) % 6000 - 100"
    " + if(l_suppkey % 43 = 0, 50000, 0))",
    "extra": "(l_linenumber % 3 * 50)",
    "tip": "if({pay} = 1, l_orderkey * 13 % 1500, 0)",
    "tolls": "if(l_partkey % 11 = 0, 554, 0)",
}


# A zone-free timestamp some seconds after the ship date, `{}` being the seconds.
_AFTER = "(l_shipdate + INTERVAL '1' SECOND * ({}))"


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    part = _TRIP | {"tip": _TRIP["tip"].format(**_TRIP)}
    after = _AFTER
    columns = {
        "vendorid": "if(l_suppkey % 50 = 0, NULL, l_suppkey % 3 + 1)",
        "tpep_pickup_datetime": after.format("{sod}"),
        "tpep_dropoff_datetime": f"if(l_partkey % 97 = 0, NULL, {after.format('{sod} + {dur}')})",
        "passenger_count": "(l_orderkey + l_linenumber) % 8",
        "trip_distance": "({dist}) / 100",
        "pickup_longitude": "{lon} / 100",
        "pickup_latitude": "{lat} / 100",
        "ratecodeid": "CASE WHEN l_suppkey % 20 = 7 THEN 99 WHEN l_orderkey % 61 = 0 THEN NULL"
        " ELSE l_partkey % 6 + 1 END",
        "store_and_fwd_flag": "if(l_returnflag = 'R', 'Y', 'N')",
        "dropoff_longitude": "({lon} + 3) / 100",
        "dropoff_latitude": "({lat} + 2) / 100",
        "payment_type": "{pay}",
        "fare_amount": "{fare} / 100",
        "extra": "{extra} / 100",
        "mta_tax": "50 / 100",
        "tip_amount": "{tip} / 100",
        "tolls_amount": "{tolls} / 100",
        "improvement_surcharge": "if(l_orderkey % 1009 = 0, NULL, 30 / 100)",
        "total_amount": "({fare} + {extra} + 50 + {tip} + {tolls} + 30) / 100",
    }
    # Spark moves no filter below a column like _row. So filters on trips read the columns derived
    # here and don't repeat their arithmetic, which made one generated method too long to be compiled.
    derived = lineitem.selectExpr(
        *(f"{e.format(**part)} AS {c}" for c, e in columns.items()), "monotonically_increasing_id() AS _row"
    )
    return derived.where("_row >= 0").drop("_row")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole raw history as one table."""
    return trips_from_lineitem(_lineitem(spark, sf_dir))


def raw_trip_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw history as two tables, split at SECOND_TABLE_FROM.

    A trip starts on its ship date, so the split is a filter on a stored column.
    """
    lineitem = _lineitem(spark, sf_dir)
    late = F.col("l_shipdate") >= F.lit(SECOND_TABLE_FROM).cast("timestamp_ntz")
    return trips_from_lineitem(lineitem.where(~late)), trips_from_lineitem(lineitem.where(late))
