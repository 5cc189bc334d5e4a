"""Registered queries: name -> (spark, sf_dir) -> DataFrame, over the whole given tables."""

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.functions import measures
from cabmill.operators import dimensions, explore, marts, quality, trips
from cabmill.plans import daily_run
from cabmill.schemas import RAW_COLUMNS, RAW_TRIP
from cabmill.sinks.store import Store
from cabmill.sources import csv_ingest, tables
from cabmill.sources.derived_trips import raw_trip_tables, raw_trips
from cabmill.sources.shared import Scratch, on_release, written

# Interval of the queries that show how an interval cuts the data.
THREE_YEARS = (date(1997, 1, 1), date(1999, 12, 31))

# Averages of true ratios depend on the order of addition in the last bits.
_RATIOS = {"avg_speed_mph", "avg_fare_per_mile", "avg_revenue_per_minute", "avg_tip_percentage"}


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.base_trip(raw_trips(spark, sf_dir))


def _enriched(spark, sf_dir):
    return trips.enriched_trip(trips.cleaned_trip(_base(spark, sf_dir)))


def _fact(spark, sf_dir):
    return trips.fact_trip(_enriched(spark, sf_dir))


def _rounded(mart: DataFrame) -> DataFrame:
    return mart.select(
        *(F.round(c, 6).alias(c) if c in _RATIOS else F.col(c) for c in mart.columns)
    )


def base_trip(spark, sf_dir):
    return trips.base_trip(*raw_trip_tables(spark, sf_dir))


def base_trip_interval(spark, sf_dir):
    start, end = THREE_YEARS
    return trips.base_trip(*raw_trip_tables(spark, sf_dir), start=start, end=end)


def base_trip_literal_interval(spark, sf_dir):
    start, end = THREE_YEARS
    return trips.base_trip(*raw_trip_tables(spark, sf_dir), start=start, end=end, mode="literal")


def cleaned_trip(spark, sf_dir):
    return trips.cleaned_trip(_base(spark, sf_dir))


def _dimension(build):
    return lambda spark, sf_dir: build(_enriched(spark, sf_dir))


def _partials(spark, sf_dir, mart) -> DataFrame:
    """The only pass over the trips: small, and written once for the joins above it."""
    return written(marts.partials_for(mart, _fact(spark, sf_dir)), mart)


# The keys of the partial rows are exactly the keys of the enriched trips, so the dimensions
# of a mart query are built from those few rows and not from a second pass over the trips.


def daily_summary(spark, sf_dir):
    parts = _partials(spark, sf_dir, "daily_summary")
    days = dimensions.dim_date(parts.withColumnRenamed("date_key", "pickup_date"))
    return _rounded(marts.daily_summary(parts, days))


def hourly_pattern(spark, sf_dir):
    parts = _partials(spark, sf_dir, "hourly_pattern")
    hours = dimensions.dim_time(parts.withColumnRenamed("time_key", "pickup_hour"))
    days = dimensions.dim_date(parts.withColumnRenamed("date_key", "pickup_date"))
    return _rounded(marts.hourly_pattern(parts, hours, days))


def vendor_performance(spark, sf_dir):
    parts = _partials(spark, sf_dir, "vendor_performance")
    vendors = dimensions.dim_vendor(parts.withColumnRenamed("vendor_key", "vendorid"))
    return _rounded(marts.vendor_performance(parts, vendors))


def payment_method(spark, sf_dir):
    parts = _partials(spark, sf_dir, "payment_method")
    payments = dimensions.dim_payment_type(
        parts.withColumnRenamed("payment_type_key", "payment_type")
    )
    return _rounded(marts.payment_method(parts, payments))


def distance_cohort(spark, sf_dir):
    parts = marts.partials_for("distance_cohort", _fact(spark, sf_dir))
    return _rounded(marts.distance_cohort(parts))


# -- sinks -------------------------------------------------------------------------------------


def _store(spark: SparkSession) -> Store:
    """A new store of its own, with tables below the shared folder."""
    tail = uuid.uuid4().hex[:12]
    location = Scratch(spark, "store").path(keep=True)
    store = Store(spark, location, env=f"q{tail}", namespace=f"cabmill_{tail}").create()
    on_release(spark, store.drop)
    return store


def _beside(store: Store, name: str) -> Store:
    """Another environment over the same store."""
    return Store(store.spark, store.location, f"{store.env}_{name}", store.namespace)


def _first_and_last_day(rows: DataFrame, time_column: str) -> tuple[date, date]:
    day = F.col(time_column).cast("date")
    return tuple(rows.agg(F.min(day), F.max(day)).first())


# The re-run interval starts and ends inside a month.
RERUN = (date(1998, 3, 10), date(1999, 2, 20))
EARLY_END = date(1997, 12, 31)


def time_range_replace(spark, sf_dir):
    """Load the history, then re-run an interval with fewer trips; some days become empty.
    Each write is a new version of a small table."""
    store, base = _store(spark), _base(spark, sf_dir)
    history = _first_and_last_day(base, trips.PICKUP)
    store.replace_days(daily_run.BASE, base, trips.PICKUP, *history)
    again = trips.cleaned_trip(base).where("payment_type = 1")
    store.replace_days(daily_run.BASE, again, trips.PICKUP, *RERUN)
    return store.read(daily_run.BASE)


def time_range_replace_day(spark, sf_dir):
    """The same with day partitions, as large tables are replaced."""
    store, base = _store(spark), _base(spark, sf_dir)
    history = _first_and_last_day(base, trips.PICKUP)
    store.replace_interval(daily_run.BASE, base, trips.PICKUP, *history)
    again = trips.cleaned_trip(base).where("payment_type = 1")
    store.replace_interval(daily_run.BASE, again, trips.PICKUP, *RERUN)
    return store.read(daily_run.BASE)


def env_isolation(spark, sf_dir):
    """Two environments write the same models, by interval and by key; rows of both.

    The second starts from the first one's rows, then replaces an interval and upserts; the
    first goes on without seeing any of it.
    """
    first = _store(spark)
    second = _beside(first, "b")
    enriched = _enriched(spark, sf_dir).selectExpr("pickup_date", "pickup_hour", "payment_type", "vendorid")
    per_day = enriched.groupBy("pickup_date", "vendorid").agg(F.count("*").alias("trips"))
    days, rerun = "mart.vendor_days", enriched.where("payment_type = 1")
    rerun = rerun.groupBy("pickup_date", "vendorid").agg(F.count("*").alias("trips"))
    keyed = "mart.vendor_last"
    last = lambda rows: rows.groupBy("vendorid").agg(F.max("pickup_date").alias("last_day"))
    early = enriched.where(F.col("pickup_date") <= EARLY_END)

    first.replace_interval(days, per_day, "pickup_date", *_first_and_last_day(per_day, "pickup_date"))
    first.upsert(keyed, last(enriched), ["vendorid"])
    second.fork(first, [days, keyed])
    second.replace_interval(days, rerun.select("trips", "vendorid", "pickup_date"), "pickup_date", *RERUN)
    second.upsert(keyed, last(early.where("vendorid = 1")), ["vendorid"])
    first.upsert(keyed, last(early.where("vendorid = 2")), ["vendorid"])
    rows = []
    for label, store in (("first", first), ("second", second)):
        mark = F.lit(label).alias("environment")
        rows.append(store.read(days).select(mark, F.lit("days").alias("model"), "vendorid", F.col("pickup_date").alias("day"), "trips"))
        rows.append(
            store.read(keyed).select(
                mark, F.lit("last").alias("model"), "vendorid", F.col("last_day").alias("day"),
                F.lit(None).cast("long").alias("trips"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def mart_before_rerun(spark, sf_dir):
    """A mart, and the trips of a large table, as they were before an interval was run again, and
    as they are now: two states that can be read side by side."""
    store, enriched = _store(spark), _enriched(spark, sf_dir)
    mart, rows = "mart.vendor_days", "mart.trip_days"
    per_day = lambda trips_: trips_.groupBy("pickup_date", "vendorid").agg(F.count("*").alias("trips"))
    narrow = enriched.select("pickup_date", "vendorid", "payment_type")
    span = _first_and_last_day(enriched, "pickup_date")
    store.replace_days(mart, per_day(narrow), "pickup_date", *span)
    store.replace_interval(rows, narrow, "pickup_date", *span)
    for model in (mart, rows):
        store.keep(model, "before_rerun")
    again = narrow.where("payment_type = 1")
    store.replace_days(mart, per_day(again), "pickup_date", *RERUN)
    store.replace_interval(rows, again, "pickup_date", *RERUN)
    store.drop_old_versions(mart, rows, keep=1)
    states = {"before": "before_rerun", "now": None}
    return _labelled("state", {
        state: store.read(mart, at).join(
            per_day(store.read(rows, at)).withColumnRenamed("trips", "stored_trips")
            .withColumnRenamed("vendorid", "v").withColumnRenamed("pickup_date", "d"),
            F.col("pickup_date").eqNullSafe(F.col("d")) & F.col("vendorid").eqNullSafe(F.col("v")), "full",
        ).select("pickup_date", "vendorid", "trips", "stored_trips")
        for state, at in states.items()
    })


def distinct_by_span(spark, sf_dir):
    """Vendors, payment types and rate codes seen per month, per year and in all, from stored
    bitmaps of each day; an interval is run again in between, and its days alone are stored anew."""
    store, model = _store(spark), "mart.day_codes"
    codes = ["vendorid", "payment_type", "ratecodeid"]
    enriched = _enriched(spark, sf_dir).select("pickup_date", *codes)
    cells = measures.distinct_cells(enriched, ["pickup_date"], codes)
    store.replace_days(model, cells, "pickup_date", *_first_and_last_day(cells, "pickup_date"))
    again = measures.distinct_cells(enriched.where("payment_type = 1"), ["pickup_date"], codes)
    store.replace_days(model, again, "pickup_date", *RERUN)
    spans = {"month": "trunc(pickup_date, 'MM')", "year": "trunc(pickup_date, 'YEAR')", "all": "CAST(NULL AS DATE)"}
    return _labelled("span", {
        span: measures.distinct_counts(store.read(model).withColumn("since", F.expr(start)), ["since"])
        for span, start in spans.items()
    })


def full_refresh(spark, sf_dir):
    """Build the date dimension from the early trips, then rebuild it from all trips."""
    store, enriched = _store(spark), _enriched(spark, sf_dir)
    early = enriched.where(F.col("pickup_date") <= EARLY_END)
    store.refresh("mart.dim_date", dimensions.dim_date(early))
    store.refresh("mart.dim_date", dimensions.dim_date(enriched))
    return store.read("mart.dim_date")


def upsert_by_key(spark, sf_dir):
    """Late events first, early events as the second batch: the later batch wins per key."""
    store = _store(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "user_id AS id", "event_type AS name", "ts AS created_at"
    )
    late = F.col("created_at") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for batch in (events.where(late), events.where(~late)):
        store.upsert("staging.hello", batch, key=["id"], order_by=["created_at"])
    return store.read("staging.hello")


def publish_env(spark, sf_dir):
    """Two environments over one store: each keeps the version that was published to it."""
    first, enriched = _store(spark), _enriched(spark, sf_dir)
    second = _beside(first, "b")
    early = enriched.where(F.col("pickup_date") <= EARLY_END)
    first.refresh("mart.dim_date", dimensions.dim_date(early))
    second.refresh("mart.dim_date", dimensions.dim_date(enriched))
    seen = [
        store.read("mart.dim_date").select(F.lit(label).alias("environment"), "date_key")
        for label, store in (("first", first), ("second", second))
    ]
    return seen[0].unionByName(seen[1])


_RUNS: dict[tuple[str, str], Store] = {}


def _two_runs(spark, sf_dir) -> Store:
    """A store after the whole flow in two intervals, over all given trips. Queries of one
    application share it until their results are released."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _RUNS:
        _RUNS[key] = _run_twice(spark, sf_dir)
        on_release(spark, lambda: _RUNS.pop(key, None))
    return _RUNS[key]


def _run_twice(spark, sf_dir) -> Store:
    store, raw = _store(spark), raw_trip_tables(spark, sf_dir)
    start, end = _first_and_last_day(raw_trips(spark, sf_dir), trips.PICKUP)
    middle = date(1998, 5, 20)
    daily_run.run(store, raw, start, middle)
    daily_run.run(store, raw, date(1998, 5, 21), end)
    return store


def daily_run_counts(spark, sf_dir):
    """Rows of every published model after two runs."""
    store = _two_runs(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        (
            explore.count_rows(store.read(m)).select(F.lit(m).alias("model"), "row_count")
            for m in daily_run.MODELS
        ),
    )


def _stored_mart(model: str):
    """A mart as its readers see it after two runs."""
    return lambda spark, sf_dir: _rounded(_two_runs(spark, sf_dir).read(model))


def published_base(spark, sf_dir):
    """Counts and averages over the published base trips of an environment."""
    store, base = _store(spark), base_trip(spark, sf_dir)
    store.refresh(daily_run.BASE, base)
    return store.read(daily_run.BASE).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg("passenger_count").alias("avg_passenger_count")
    )


def two_windows(spark, sf_dir):
    """Rows of an interval by timestamp and, in the same statement, by date."""
    start, end = THREE_YEARS
    base = trips.base_trip(*raw_trip_tables(spark, sf_dir), start=start, end=end)
    within = F.expr(f"CAST({trips.PICKUP} AS DATE) BETWEEN DATE '{RERUN[0]}' AND DATE '{RERUN[1]}'")
    return base.where(within)


# -- contracts ---------------------------------------------------------------------------------


def schema_contract(spark, sf_dir):
    """The raw trips with a lost, a changed and an undeclared column."""
    drifted = (
        raw_trips(spark, sf_dir)
        .drop("mta_tax")
        .withColumn("passenger_count", F.col("passenger_count").cast("int"))
        .withColumn("congestion_surcharge", F.col("improvement_surcharge"))
    )
    return quality.contract_report(drifted, RAW_TRIP)


def output_shapes(spark, sf_dir):
    """Column problems of every given table, and of three projections over them: a star over a
    join, an expression without a name, and the trips."""
    given = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in _GIVEN_TABLES}
    orders, documents = given["orders"], given["documents"]
    frames = given | {
        "star_over_join": documents.join(given["labels"], documents.doc_id == given["labels"].doc_id),
        "expression": orders.selectExpr("o_orderkey + 1", "o_orderkey AS `1st`", "o_orderkey AS order_key"),
        "trips": raw_trips(spark, sf_dir),
    }
    return _labelled("table_name", {name: quality.shape_report(frame) for name, frame in frames.items()})


def box_trips(spark, sf_dir):
    """Trips per day inside a box, from a table whose days are laid out along a curve over the
    pickup place: the box reads the files and row groups that meet it."""
    store, base = _store(spark), _base(spark, sf_dir)
    history = _first_and_last_day(base, trips.PICKUP)
    store.replace_interval(daily_run.BASE, base, trips.PICKUP, *history, curve=trips.PICKUP_CURVE)
    in_box = store.read(daily_run.BASE).where(
        "pickup_latitude BETWEEN 40.60D AND 40.75D AND pickup_longitude BETWEEN -74.20D AND -74.00D"
    )
    return explore.rows_per_day(in_box, trips.PICKUP)


def fk_audit(spark, sf_dir):
    """All trips against dimensions that were last built at EARLY_END.

    One pass over the trips: what is left are the key combinations with their trips.
    """
    names = dimensions.KEY_COLUMNS
    keys = written(
        _enriched(spark, sf_dir).groupBy(*names).agg(F.count(F.lit(1)).alias("trips")), "star-keys"
    )
    early = keys.where(F.col("pickup_date") <= EARLY_END)
    dims = {name.split(".")[1]: build(early) for name, build in daily_run.DIMENSIONS.items()}
    fact = keys.withColumnsRenamed(dict(zip(names, quality.STAR_KEYS, strict=True)))
    return quality.star_key_audit(fact, dims)


def trip_key_duplicates(spark, sf_dir):
    return quality.trip_key_duplicates(_fact(spark, sf_dir))


# -- exploration -------------------------------------------------------------------------------


def count_trips(spark, sf_dir):
    return explore.count_rows(base_trip(spark, sf_dir))


def avg_passengers(spark, sf_dir):
    return explore.average_of(base_trip(spark, sf_dir), "passenger_count", "avg_passenger_count")


def trips_per_day(spark, sf_dir):
    return explore.rows_per_day(_base(spark, sf_dir), trips.PICKUP)


def head_trips(spark, sf_dir):
    order = [trips.PICKUP, *(c for c in RAW_COLUMNS if c != trips.PICKUP)]
    return explore.head(_base(spark, sf_dir), order, 10)


def table_profile(spark, sf_dir):
    profiled = explore.profile(raw_trips(spark, sf_dir))
    return profiled.withColumns({"mean": F.round("mean", 8), "std": F.round("std", 6)})


def fact_profile(spark, sf_dir):
    """The fact table's profile: whole numbers, amounts, times, texts and its flags."""
    profiled = explore.profile(_fact(spark, sf_dir))
    return profiled.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 4)})


def group_size_window(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type")
    return explore.with_group_size(events, ["event_type"], "name_count")


def global_row_number(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "ts")
    return explore.with_row_number(events, ["ts", "event_id"], "row_num")


def schema_rows(spark, sf_dir):
    return tables.schema_rows(raw_trips(spark, sf_dir))


_GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def catalog_tables(spark, sf_dir):
    """Register the given files as tables of a namespace, list them and count their rows."""
    namespace = f"cabmill_{uuid.uuid4().hex[:12]}"
    folder = Scratch(spark, "catalog").path(keep=True)
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{folder}'")
    on_release(spark, lambda: spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE"))
    for name in _GIVEN_TABLES:
        path = f"{sf_dir}/{name}.parquet"
        spark.sql(f"CREATE TABLE {namespace}.{name} USING parquet OPTIONS (path '{path}')")
    counts = (
        explore.count_rows(spark.table(f"{namespace}.{name}")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in _GIVEN_TABLES
    )
    listed = tables.namespaces(spark).where(F.col("namespace") == namespace).join(
        tables.tables_in(spark, namespace), "namespace"
    )
    return listed.join(reduce(DataFrame.unionByName, counts), "table_name").select(
        F.lit("given").alias("namespace"), "table_name", "row_count"
    )


# -- ingest and backends -----------------------------------------------------------------------


def _labelled(column: str, frames: dict[str, DataFrame]) -> DataFrame:
    """The frames on top of each other, each marked with its name."""
    marked = (frame.withColumn(column, F.lit(name)) for name, frame in frames.items())
    return reduce(DataFrame.unionByName, marked)


def csv_ingest_report(spark, sf_dir):
    """Write both raw tables as CSV, some lines unreadable, and beside them a file with a wrong
    header; ingest all into one raw table and compare."""
    loads, accepted, differing = {}, {}, {}
    bad = F.col("improvement_surcharge").isNull()
    for name, raw in zip(("trips_1", "trips_2"), raw_trip_tables(spark, sf_dir), strict=True):
        scratch = Scratch(spark, f"{name}-csv")
        source, target = scratch.path(keep=True), scratch.path(keep=True)
        texts = raw.select(*(F.col(c).cast("string").alias(c) for c in RAW_COLUMNS)).withColumn(
            trips.DROPOFF, F.when(bad, "unreadable").otherwise(F.col(trips.DROPOFF))
        )
        texts.write.option("header", True).csv(source)
        spark.range(1).write.option("header", True).mode("append").csv(source)
        report = csv_ingest.ingest_csv(spark, source, target)
        loads[name] = report.agg(
            F.sum("row_count").alias("row_count"), F.sum("corrupt_rows").alias("corrupt_rows"),
            (F.count_if(F.col("status") == csv_ingest.WRONG_HEADER) > 0).cast("long").alias("wrong_headers"),
        )
        good = csv_ingest.accepted_rows(spark, target)
        accepted[name] = good.agg(F.count(F.lit(1)).alias("accepted_rows"))
        differing[name] = quality.table_difference(good, raw.where(~bad)).agg(
            F.count(F.lit(1)).alias("differing_rows")
        )
    key = "table_name"
    return (
        _labelled(key, loads)
        .join(_labelled(key, accepted), key)
        .join(_labelled(key, differing), key)
    )


def source_parity(spark, sf_dir):
    """The base trips from two storage formats give the same answers and the same rows."""
    base = base_trip(spark, sf_dir)
    backends = {}
    for file_format in ("parquet", "orc"):
        path = Scratch(spark, f"parity-{file_format}").path(keep=True)
        base.write.format(file_format).save(path)
        backends[file_format] = tables.scan(spark, path, file_format)
    answers = {
        name: rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.avg("passenger_count").alias("avg_passenger_count"),
        )
        for name, rows in backends.items()
    }
    # Surplus rows of the first backend count for it, missing ones for the second.
    difference = quality.table_difference_by_cell(*backends.values(), trips.PICKUP)
    differing = {
        name: difference.agg(F.count_if(F.col("surplus") * sign > 0).alias("differing_rows"))
        for name, sign in zip(backends, (1, -1), strict=True)
    }
    return _labelled("backend", answers).join(_labelled("backend", differing), "backend")


QUERIES = {
    "base_trip": base_trip,
    "base_trip_interval": base_trip_interval,
    "base_trip_literal_interval": base_trip_literal_interval,
    "cleaned_trip": cleaned_trip,
    "enriched_trip": _enriched,
    "fact_trip": _fact,
    "dim_date": _dimension(dimensions.dim_date),
    "dim_time": _dimension(dimensions.dim_time),
    "dim_vendor": _dimension(dimensions.dim_vendor),
    "dim_payment_type": _dimension(dimensions.dim_payment_type),
    "dim_rate_code": _dimension(dimensions.dim_rate_code),
    "daily_summary": daily_summary,
    "hourly_pattern": hourly_pattern,
    "vendor_performance": vendor_performance,
    "payment_method": payment_method,
    "distance_cohort": distance_cohort,
    "time_range_replace": time_range_replace,
    "time_range_replace_day": time_range_replace_day,
    "env_isolation": env_isolation,
    "mart_before_rerun": mart_before_rerun,
    "distinct_by_span": distinct_by_span,
    "full_refresh": full_refresh,
    "upsert_by_key": upsert_by_key,
    "publish_env": publish_env,
    "daily_run": daily_run_counts,
    **{
        f"daily_run_{model.removeprefix('mart.analytics_')}": _stored_mart(model)
        for model in daily_run.MARTS
    },
    "published_base": published_base,
    "two_windows": two_windows,
    "schema_contract": schema_contract,
    "output_shapes": output_shapes,
    "box_trips": box_trips,
    "fk_audit": fk_audit,
    "trip_key_duplicates": trip_key_duplicates,
    "count_trips": count_trips,
    "avg_passengers": avg_passengers,
    "trips_per_day": trips_per_day,
    "head_trips": head_trips,
    "table_profile": table_profile,
    "fact_profile": fact_profile,
    "group_size_window": group_size_window,
    "global_row_number": global_row_number,
    "schema_rows": schema_rows,
    "catalog_tables": catalog_tables,
    "csv_ingest_report": csv_ingest_report,
    "source_parity": source_parity,
}
