"""The five analytic marts, computed from partial rows and small dimensions.

Every mart is `grain -> partials -> join -> select`:

* trips are reduced to partial rows at the mart's grain first, so the star join handles one
  row per (date, key) instead of one per trip;
* the inner join then drops keys that no dimension holds (NULL vendors and payment types),
  and shares are taken over what is left;
* no join carries a broadcast hint: the dimensions and the partial rows have known sizes
  (read from written tables), and Spark broadcasts below its threshold or shuffles above it.

`partials` may have any finer grain than the mart: one table at CELL_GRAIN serves all five.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabmill.functions.measures import mean, partials, percent, roll_up, total

DAY, HOUR, VENDOR = "date_key", "time_key", "vendor_key"
PAYMENT, BAND = "payment_type_key", "distance_category"

CELL_GRAIN = (DAY, HOUR, VENDOR, PAYMENT, BAND)

# Per mart: grain of its partial rows, measures and conditions it reads.
GRAINS = {
    "daily_summary": (DAY, VENDOR),
    "hourly_pattern": (DAY, HOUR),
    "vendor_performance": (DAY, VENDOR),
    "payment_method": (DAY, PAYMENT),
    "distance_cohort": (DAY, BAND),
}
MEASURES_READ = {
    "daily_summary": (
        "passengers", "distance", "duration", "speed", "fare", "tip", "total",
        "per_minute", "tip_ratio",
    ),
    "hourly_pattern": (
        "passengers", "distance", "duration", "speed", "total", "fare", "tip", "tip_ratio",
        "per_minute", "fare_per_mile",
    ),
    "vendor_performance": (
        "passengers", "distance", "duration", "speed", "total", "fare", "fare_per_mile",
        "per_minute", "tip", "tip_ratio",
    ),
    "payment_method": (
        "passengers", "distance", "duration", "total", "fare", "per_minute", "tip",
        "tip_ratio", "extra", "tolls",
    ),
    "distance_cohort": (
        "passengers", "distance", "duration", "speed", "total", "fare", "fare_per_mile",
        "per_minute", "tip", "tip_ratio",
    ),
}
CONDITIONS_READ = {
    "daily_summary": (
        "tipped", "high_tip", "card", "cash", "standard_rate", "jfk", "airport",
        "short", "medium", "long",
    ),
    "hourly_pattern": ("short", "medium", "airport"),
    "vendor_performance": ("high_tip", "card", "cash", "airport", "short", "medium", "long"),
    "payment_method": ("tipped", "high_tip", "short", "medium", "long", "airport"),
    "distance_cohort": ("high_tip", "rush_hour", "weekend", "card", "cash", "airport"),
}


def trip_cells(fact: DataFrame) -> DataFrame:
    """Partial rows at the finest grain any mart needs: one trip scan for all five marts.

    Meant for a fact table partitioned by date, where a task meets few dates and the map-side
    combine shrinks its rows to at most a few thousand cells per date.
    """
    return partials(fact, CELL_GRAIN)


def partials_for(mart: str, fact: DataFrame) -> DataFrame:
    """Partial rows for one mart alone, at its own grain, with only the columns it reads."""
    return partials(fact, GRAINS[mart], MEASURES_READ[mart], CONDITIONS_READ[mart])


def _share_of_day(alias: str) -> str:
    return percent("trips", f"sum(trips) OVER (PARTITION BY {DAY})", alias)


def daily_summary(parts: DataFrame, dim_date: DataFrame) -> DataFrame:
    vendors = F.count_distinct(F.col(VENDOR)).alias("active_vendors")
    days = roll_up(parts, [DAY], vendors)
    return days.join(dim_date.select(DAY, "day_name", "is_weekend"), DAY).selectExpr(
        f"{DAY} AS trip_date",
        "day_name",
        "is_weekend",
        "trips AS total_trips",
        "active_vendors",
        total("passengers", "total_passengers"),
        mean("passengers", "avg_passengers_per_trip"),
        total("distance", "total_distance_miles"),
        mean("distance", "avg_distance_miles"),
        mean("duration", "avg_duration_minutes"),
        mean("speed", "avg_speed_mph"),
        total("fare", "total_fare_amount"),
        total("tip", "total_tip_amount"),
        total("total", "total_revenue"),
        mean("fare", "avg_fare_amount"),
        mean("tip", "avg_tip_amount"),
        mean("total", "avg_total_amount"),
        mean("per_minute", "avg_revenue_per_minute"),
        mean("tip_ratio", "avg_tip_percentage"),
        "if_tipped AS trips_with_tips",
        "if_high_tip AS high_tip_trips",
        "if_card AS credit_card_trips",
        "if_cash AS cash_trips",
        "if_standard_rate AS standard_rate_trips",
        "if_jfk AS jfk_trips",
        "if_airport AS airport_trips",
        "if_short AS short_distance_trips",
        "if_medium AS medium_distance_trips",
        "if_long AS long_distance_trips",
    )


def hourly_pattern(parts: DataFrame, dim_time: DataFrame, dim_date: DataFrame) -> DataFrame:
    hours = roll_up(parts, [DAY, HOUR])
    starred = hours.join(dim_time, HOUR).join(dim_date.select(DAY, "is_weekend"), DAY)
    return starred.selectExpr(
        f"{DAY} AS trip_date",
        f"{HOUR} AS trip_hour",
        "time_of_day",
        "is_rush_hour",
        "is_weekend",
        "trips AS total_trips",
        mean("passengers", "avg_passengers_per_trip"),
        mean("distance", "avg_distance_miles"),
        mean("duration", "avg_duration_minutes"),
        mean("speed", "avg_speed_mph"),
        total("total", "total_revenue"),
        mean("fare", "avg_fare_amount"),
        mean("tip", "avg_tip_amount"),
        mean("tip_ratio", "avg_tip_percentage"),
        mean("per_minute", "avg_revenue_per_minute"),
        mean("fare_per_mile", "avg_fare_per_mile"),
        "if_short AS short_distance_trips",
        "if_medium AS medium_distance_trips",
        "if_airport AS airport_trips",
    )


def vendor_performance(parts: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    vendors = roll_up(parts, [DAY, VENDOR]).join(dim_vendor, VENDOR)
    return vendors.selectExpr(
        f"{DAY} AS trip_date",
        VENDOR,
        "vendor_name",
        "trips AS total_trips",
        _share_of_day("market_share_pct"),
        total("passengers", "total_passengers"),
        mean("passengers", "avg_passengers_per_trip"),
        total("distance", "total_distance_miles"),
        mean("distance", "avg_distance_miles"),
        mean("duration", "avg_duration_minutes"),
        mean("speed", "avg_speed_mph"),
        total("total", "total_revenue"),
        mean("fare", "avg_fare_amount"),
        mean("total", "avg_total_amount"),
        mean("fare_per_mile", "avg_fare_per_mile"),
        mean("per_minute", "avg_revenue_per_minute"),
        total("tip", "total_tips"),
        mean("tip", "avg_tip_amount"),
        mean("tip_ratio", "avg_tip_percentage"),
        "if_high_tip AS high_tip_trips",
        percent("if_card", "trips", "credit_card_pct"),
        percent("if_cash", "trips", "cash_pct"),
        "if_airport AS airport_trips",
        "if_short AS short_distance_trips",
        "if_medium AS medium_distance_trips",
        "if_long AS long_distance_trips",
    )


def payment_method(parts: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    payments = roll_up(parts, [DAY, PAYMENT]).join(dim_payment_type, PAYMENT)
    return payments.selectExpr(
        f"{DAY} AS trip_date",
        PAYMENT,
        "payment_type_name",
        "trips AS total_trips",
        _share_of_day("payment_method_share_pct"),
        mean("passengers", "avg_passengers_per_trip"),
        mean("distance", "avg_distance_miles"),
        mean("duration", "avg_duration_minutes"),
        total("total", "total_revenue"),
        mean("fare", "avg_fare_amount"),
        mean("total", "avg_total_amount"),
        mean("per_minute", "avg_revenue_per_minute"),
        total("tip", "total_tips"),
        mean("tip", "avg_tip_amount"),
        mean("tip_ratio", "avg_tip_percentage"),
        "if_tipped AS trips_with_tips",
        percent("if_tipped", "trips", "tip_rate_pct"),
        "if_high_tip AS high_tip_trips",
        mean("extra", "avg_extra_charges"),
        mean("tolls", "avg_tolls"),
        "if_short AS short_distance_trips",
        "if_medium AS medium_distance_trips",
        "if_long AS long_distance_trips",
        "if_airport AS airport_trips",
    )


def distance_cohort(parts: DataFrame) -> DataFrame:
    cohorts = roll_up(parts, [DAY, BAND])
    return cohorts.selectExpr(
        f"{DAY} AS trip_date",
        BAND,
        "trips AS total_trips",
        _share_of_day("trip_share_pct"),
        total("passengers", "total_passengers"),
        mean("passengers", "avg_passengers_per_trip"),
        total("distance", "total_distance_miles"),
        mean("distance", "avg_distance_miles"),
        "min_distance AS min_distance_miles",
        "max_distance AS max_distance_miles",
        mean("duration", "avg_duration_minutes"),
        mean("speed", "avg_speed_mph"),
        total("total", "total_revenue"),
        mean("fare", "avg_fare_amount"),
        mean("total", "avg_total_amount"),
        mean("fare_per_mile", "avg_fare_per_mile"),
        mean("per_minute", "avg_revenue_per_minute"),
        mean("tip", "avg_tip_amount"),
        mean("tip_ratio", "avg_tip_percentage"),
        "if_high_tip AS high_tip_trips",
        "if_rush_hour AS rush_hour_trips",
        "if_weekend AS weekend_trips",
        "if_card AS credit_card_trips",
        "if_cash AS cash_trips",
        "if_airport AS airport_trips",
    )
