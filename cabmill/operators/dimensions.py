"""The five dimensions: the distinct codes seen in the enriched trips, with attributes.

Each reads one column and combines map-side, so a build scans a narrow, well-compressed
column and shuffles only distinct values.
"""

from pyspark.sql import DataFrame

from cabmill import schemas as S
from cabmill.functions import expressions as X


#: Columns of the enriched trips that hold the keys of the dimensions.
KEY_COLUMNS = ("pickup_date", "pickup_hour", "vendorid", "payment_type", "ratecodeid")


def _seen(trips: DataFrame, column: str, name: str) -> DataFrame:
    return trips.selectExpr(f"{column} AS {name}").distinct()


def dim_date(enriched: DataFrame) -> DataFrame:
    day = "date_key"
    return _seen(enriched, "pickup_date", day).selectExpr(
        day,
        f"year({day}) AS year",
        f"quarter({day}) AS quarter",
        f"month({day}) AS month",
        f"day({day}) AS day",
        f"{X.day_of_week(day)} AS day_of_week",
        f"dayofyear({day}) AS day_of_year",
        f"weekofyear({day}) AS week_of_year",
        f"{X.padded_name(day, 'MMMM')} AS month_name",
        f"{X.padded_name(day, 'EEEE')} AS day_name",
        f"{X.is_weekend(day)} AS is_weekend",
    )


def dim_time(enriched: DataFrame) -> DataFrame:
    hour = "time_key"
    return _seen(enriched, "pickup_hour", hour).selectExpr(
        hour,
        f"{X.day_part(hour)} AS time_of_day",
        f"{X.is_rush_hour(hour)} AS is_rush_hour",
    )


def _code_dimension(enriched, code, key, label, names):
    return (
        _seen(enriched, code, key)
        .where(f"{key} IS NOT NULL")
        .selectExpr(key, f"{X.label_of(key, names)} AS {label}")
    )


def dim_vendor(enriched: DataFrame) -> DataFrame:
    return _code_dimension(enriched, "vendorid", "vendor_key", "vendor_name", S.VENDOR_NAMES)


def dim_payment_type(enriched: DataFrame) -> DataFrame:
    return _code_dimension(
        enriched, "payment_type", "payment_type_key", "payment_type_name", S.PAYMENT_TYPE_NAMES
    )


def dim_rate_code(enriched: DataFrame) -> DataFrame:
    return _code_dimension(
        enriched, "ratecodeid", "rate_code_key", "rate_code_name", S.RATE_CODE_NAMES
    )
