"""The whole flow for one interval: raw tables -> trips -> star schema -> marts.

    spark-submit --conf spark.checkpoint.dir=/shared/scratch cabmill/plans/daily_run.py \\
        --raw 2015.parquet 2016.parquet --location /shared/lake \\
        --start 2015-01-01 --end 2015-01-31 [--env prod]

(with the project on PYTHONPATH or in --py-files, and a persistent catalog). Without --env the
run goes to the environment of its user.

Row-level models are partitioned by day. Only the first one shuffles, to gather each day into
few files; the next three are narrow steps from one day-partitioned table to the next. The
fact table is read once for all five marts. The dimensions are the same as if built from all
trips, but come from a small table of the key combinations of each day, of which only the
interval is replaced. All views switch at the end of the run.
"""

import argparse
from collections.abc import Collection, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cabmill.operators import dimensions, marts, trips
from cabmill.sinks.store import Store, default_environment
from cabmill.sources.shared import Scratch, short_methods
from cabmill.sources.tables import scan

# The published model names.

BASE = "intermediate.base_yellow_trip"
CLEANED = "intermediate.cleaned_yellow_trip"
ENRICHED = "intermediate.enriched_yellow_trip"
FACT = "mart.fact_trip"
ROW_MODELS = (BASE, CLEANED, ENRICHED, FACT)
DIMENSIONS = {
    "mart.dim_date": dimensions.dim_date,
    "mart.dim_time": dimensions.dim_time,
    "mart.dim_vendor": dimensions.dim_vendor,
    "mart.dim_payment_type": dimensions.dim_payment_type,
    "mart.dim_rate_code": dimensions.dim_rate_code,
}
MARTS = {
    "mart.analytics_daily_summary": (marts.daily_summary, ["mart.dim_date"]),
    "mart.analytics_hourly_pattern": (marts.hourly_pattern, ["mart.dim_time", "mart.dim_date"]),
    "mart.analytics_vendor_performance": (marts.vendor_performance, ["mart.dim_vendor"]),
    "mart.analytics_payment_method": (marts.payment_method, ["mart.dim_payment_type"]),
    "mart.analytics_distance_cohort": (marts.distance_cohort, []),
}
MODELS = [*ROW_MODELS, *DIMENSIONS, *MARTS]
# The distinct key combinations of every day, from which the dimensions are built.
STAR_KEYS = "intermediate.star_keys"


def run(
    store: Store,
    raw: Sequence[DataFrame],
    start: date,
    end: date,
    mode: str = "half_open",
    stored: Collection[str] = ROW_MODELS,
) -> None:
    """Recompute the days start..end of every model and publish them together.

    `stored` names the row-level models to keep as tables. By default that is all four; each
    is a full copy of the interval's trips. Leaving out the base and cleaned trips halves the
    bytes written: they are then computed on the way to the enriched trips, in the same stage.
    """
    if not {ENRICHED, FACT} <= set(stored):
        raise ValueError("dimensions and marts need the enriched trips and the fact table")
    clustered = False  # until the first stored table has gathered the days

    def step(model, frame, time_column):
        nonlocal clustered
        if model not in stored:
            return frame
        store.replace_interval(model, frame, time_column, start, end, clustered)
        clustered = True
        return store.interval(model, time_column, start, end)

    spark = store.spark
    with short_methods(spark), Scratch(spark, "daily-run") as scratch, store.one_switch():
        base = trips.base_trip(*raw, start=start, end=end, mode=mode)
        base = step(BASE, base, trips.PICKUP)
        cleaned = step(CLEANED, trips.cleaned_trip(base), trips.PICKUP)
        enriched = step(ENRICHED, trips.enriched_trip(cleaned), "pickup_date")
        fact = step(FACT, trips.fact_trip(enriched), "date_key")

        keys = enriched.select(*dimensions.KEY_COLUMNS).distinct()
        store.replace_days(STAR_KEYS, keys, "pickup_date", start, end)
        for model, build in DIMENSIONS.items():
            store.refresh(model, build(store.read(STAR_KEYS)))

        cells = scratch.written(marts.trip_cells(fact))
        for model, (build, dims) in MARTS.items():
            mart = build(cells, *(store.read(d) for d in dims))
            store.replace_days(model, mart, "trip_date", start, end)
    store.drop_old_versions(*stored, STAR_KEYS, *DIMENSIONS, *MARTS)


def main() -> None:
    parser = argparse.ArgumentParser(description="Recompute all models for an interval of days")
    parser.add_argument("--raw", nargs="+", required=True, help="paths of the raw trip tables")
    parser.add_argument("--format", default="parquet", help="file format of the raw tables")
    parser.add_argument("--location", required=True, help="shared folder of the tables")
    parser.add_argument("--start", type=date.fromisoformat, required=True)
    parser.add_argument("--end", type=date.fromisoformat, required=True)
    parser.add_argument("--env", default=default_environment())
    parser.add_argument(
        "--store", nargs="+", default=ROW_MODELS, choices=ROW_MODELS, help="row-level tables to keep"
    )
    args = parser.parse_args()
    spark = SparkSession.builder.appName("cabmill").enableHiveSupport().getOrCreate()
    raw = [scan(spark, path, args.format) for path in args.raw]
    store = Store(spark, args.location, args.env).create()
    run(store, raw, args.start, args.end, stored=args.store)


if __name__ == "__main__":
    main()
