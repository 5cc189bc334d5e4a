"""Oracle SQL by query name."""

from oracle.trips import (
    CLEANED,
    DIMENSIONS,
    FACT,
    MARTS,
    RAW,
    base,
    chain,
    mart_sql,
    through_enriched,
)

_LITERAL = """ base AS (
  SELECT * FROM raw
  WHERE tpep_pickup_datetime BETWEEN DATE '1997-01-01' AND DATE '1999-12-31')"""

_RERUN = "CAST(tpep_pickup_datetime AS DATE) BETWEEN DATE '1998-03-10' AND DATE '1999-02-20'"
_EARLY = "<= DATE '1997-12-31'"

# Raw columns in contract order: name -> type.
_COLUMNS = {
    "vendorid": "bigint", "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz", "passenger_count": "bigint",
    "trip_distance": "double", "pickup_longitude": "double", "pickup_latitude": "double",
    "ratecodeid": "bigint", "store_and_fwd_flag": "string", "dropoff_longitude": "double",
    "dropoff_latitude": "double", "payment_type": "bigint", "fare_amount": "double",
    "extra": "double", "mta_tax": "double", "tip_amount": "double", "tolls_amount": "double",
    "improvement_surcharge": "double", "total_amount": "double",
}


def _union(selects):
    return "\nUNION ALL ".join(selects)


def _contract_line(name, expected, actual, status, counted):
    values = f"count({counted})" if counted else "0::BIGINT"
    return (
        f"SELECT '{name}' AS column_name, '{expected}' AS expected_type,"
        f" '{actual}' AS actual_type, '{status}' AS status, {values} AS value_count,"
        f" count(*) - {values} AS null_count FROM raw"
    )


def _contract():
    lines = []
    for name, kind in _COLUMNS.items():
        if name == "mta_tax":
            lines.append(_contract_line(name, kind, "", "missing", None))
        elif name == "passenger_count":
            lines.append(_contract_line(name, kind, "int", "type_mismatch", name))
        else:
            lines.append(_contract_line(name, kind, kind, "ok", name))
    surcharge = "improvement_surcharge"
    lines.append(_contract_line("congestion_surcharge", "", "double", "extra", surcharge))
    return _union(lines)


def _schema_rows():
    return _union(
        f"SELECT {i}::INTEGER AS position, '{name}' AS column_name, '{kind}' AS data_type,"
        f" count(*) AS row_count FROM raw"
        for i, (name, kind) in enumerate(_COLUMNS.items(), 1)
    )


def _audit():
    names = {
        "date_key": "pickup_date", "time_key": "pickup_hour", "vendor_key": "vendorid",
        "payment_type_key": "payment_type", "rate_code_key": "ratecodeid",
    }
    return _union(
        f"SELECT '{key}' AS key, count(*) AS trips, count(*) - count({c}) AS null_keys,"
        f" count(*) FILTER (WHERE {c} NOT IN (SELECT {c} FROM enriched"
        f" WHERE pickup_date {_EARLY} AND {c} IS NOT NULL)) AS orphan_keys FROM enriched"
        for key, c in names.items()
    )


def _profile(columns, source, mean_places, std_places):
    points = {"min": None, "q25": 0.25, "q50": 0.5, "q75": 0.75, "max": None}

    def point(name, column):
        share = points[name]
        return f"quantile_disc({column}, {share})" if share else f"{name}({column})"

    lines = []
    for name, kind in columns.items():
        number = kind in ("bigint", "int", "double")
        time = kind in ("timestamp_ntz", "date")
        text = kind in ("string", "boolean")
        mean = f"round(avg({name}), {mean_places})"
        if kind == "boolean":
            mean = f"round(avg({name}::INT), {mean_places})"
        items = [
            f"'{name}' AS column_name",
            f"count({name}) AS count",
            f"count(*) - count({name}) AS null_count",
            (mean if number or kind == "boolean" else "NULL::DOUBLE") + " AS mean",
            (f"round(stddev_samp({name}), {std_places})" if number else "NULL::DOUBLE") + " AS std",
        ]
        for p in points:
            value = f"CAST({point(p, name)} AS DOUBLE)" if number else "NULL::DOUBLE"
            items.append(f"{value} AS {p}")
        stamp = f"{name}::TIMESTAMP"
        mean = f"make_timestamp(CAST(sum(epoch_us({stamp})) // count({name}) AS BIGINT))"
        items.append((mean if time else "NULL::TIMESTAMP") + " AS mean_ts")
        for p in points:
            items.append((point(p, stamp) if time else "NULL::TIMESTAMP") + f" AS {p}_ts")
        for p in ("min", "max"):
            value = point(p, f"{name}::VARCHAR") if text else "NULL::VARCHAR"
            items.append(f"{value} AS {p}_text")
        lines.append(f"SELECT {', '.join(items)} FROM {source}")
    return _union(lines)


_RENAMED = {
    "vendorid": "vendor_key", "payment_type": "payment_type_key", "ratecodeid": "rate_code_key",
    "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime",
}
_FACT_COLUMNS = {
    "trip_key": "string",
    **{_RENAMED.get(name, name): kind for name, kind in _COLUMNS.items()},
    "date_key": "date", "time_key": "int", "trip_duration_minutes": "double",
    "avg_speed_mph": "double", "fare_per_mile": "double", "tip_percentage": "double",
    "revenue_per_minute": "double", "distance_category": "string", "duration_category": "string",
    "is_rush_hour": "boolean", "is_weekend": "boolean", "is_airport_trip": "boolean",
    "is_high_tip": "boolean",
}

_MODEL_COUNTS = {
    "intermediate.base_yellow_trip": "SELECT * FROM base",
    "intermediate.cleaned_yellow_trip": "SELECT * FROM cleaned",
    "intermediate.enriched_yellow_trip": "SELECT * FROM enriched",
    "mart.fact_trip": "SELECT * FROM enriched",
    **{f"mart.{name}": f"SELECT * FROM {name}" for name in DIMENSIONS},
    "mart.analytics_daily_summary": "SELECT DISTINCT pickup_date FROM enriched",
    "mart.analytics_hourly_pattern": "SELECT DISTINCT pickup_date, pickup_hour FROM enriched",
    "mart.analytics_vendor_performance": "SELECT DISTINCT pickup_date, vendorid FROM enriched"
    " WHERE vendorid IS NOT NULL",
    "mart.analytics_payment_method": "SELECT DISTINCT pickup_date, payment_type FROM enriched"
    " WHERE payment_type IS NOT NULL",
    "mart.analytics_distance_cohort": "SELECT DISTINCT pickup_date, distance_category"
    " FROM enriched",
}

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_REPLACED = chain(
    RAW,
    base(),
    CLEANED,
    select=f"SELECT * FROM base WHERE NOT ({_RERUN})"
    f" UNION ALL SELECT * FROM cleaned WHERE {_RERUN} AND payment_type = 1",
)

_ISOLATION = """
SELECT 'first' AS environment, 'days' AS model, vendorid, pickup_date AS day, count(*) AS trips
FROM enriched GROUP BY ALL
UNION ALL SELECT 'second', 'days', vendorid, pickup_date, count(*) FROM enriched
WHERE pickup_date NOT BETWEEN DATE '1998-03-10' AND DATE '1999-02-20' OR payment_type = 1 GROUP BY ALL
UNION ALL SELECT 'first', 'last', vendorid,
 if(vendorid = 2, max(pickup_date) FILTER (WHERE pickup_date <= DATE '1997-12-31'), max(pickup_date)), NULL
FROM enriched GROUP BY vendorid
UNION ALL SELECT 'second', 'last', vendorid,
 if(vendorid = 1, max(pickup_date) FILTER (WHERE pickup_date <= DATE '1997-12-31'), max(pickup_date)), NULL
FROM enriched GROUP BY vendorid"""

_BEFORE_RERUN = """
SELECT 'before' AS state, pickup_date, vendorid, count(*) AS trips, count(*) AS stored_trips FROM enriched GROUP BY ALL
UNION ALL SELECT 'now', pickup_date, vendorid, count(*), count(*) FROM enriched
WHERE pickup_date NOT BETWEEN DATE '1998-03-10' AND DATE '1999-02-20' OR payment_type = 1 GROUP BY ALL"""

_KEPT_AFTER_RERUN = "(pickup_date NOT BETWEEN DATE '1998-03-10' AND DATE '1999-02-20' OR payment_type = 1)"
_SPANS = _union(
    f"SELECT '{span}' AS span, {since} AS since, '{code}' AS column_name,"
    f" CAST(count(DISTINCT {code}) AS BIGINT) AS distinct_values FROM enriched"
    f" WHERE {_KEPT_AFTER_RERUN} AND {code} IS NOT NULL GROUP BY ALL"
    for span, since in (
        ("month", "CAST(date_trunc('month', pickup_date) AS DATE)"),
        ("year", "CAST(date_trunc('year', pickup_date) AS DATE)"), ("all", "CAST(NULL AS DATE)"),
    )
    for code in ("vendorid", "payment_type", "ratecodeid")
)

def _shapes():
    lines = [
        f"SELECT '{t}' AS table_name, CAST(c.ordinal_position AS INTEGER) AS position, c.column_name,"
        f" '' AS problem, (SELECT count(*) FROM {t}) AS row_count"
        f" FROM information_schema.columns c WHERE c.table_name = '{t}'"
        for t in _TABLES
    ]
    joined = "(SELECT count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
    made = [
        *(("star_over_join", c, "duplicate" if c == "doc_id" else "", joined)
          for c in ("doc_id", "text", "lang", "source", "n_chars", "doc_id", "quality", "toxic")),
        *(("expression", c, problem, "(SELECT count(*) FROM orders)")
          for c, problem in (("(o_orderkey + 1)", "unnamed"), ("1st", "unnamed"), ("order_key", ""))),
        *(("trips", c, "", "(SELECT count(*) FROM lineitem)") for c in _COLUMNS),
    ]
    place: dict[str, int] = {}
    for name, column, problem, rows in made:
        place[name] = place.get(name, 0) + 1
        lines.append(f"SELECT '{name}', {place[name]}, '{column}', '{problem}', {rows}")
    return _union(lines)


ORACLE = {
    "base_trip": chain(RAW, base(), select="SELECT * FROM base"),
    "base_trip_interval": chain(
        RAW, base("1997-01-01", "1999-12-31"), select="SELECT * FROM base"
    ),
    "base_trip_literal_interval": chain(RAW, _LITERAL, select="SELECT * FROM base"),
    "cleaned_trip": chain(RAW, base(), CLEANED, select="SELECT * FROM cleaned"),
    "enriched_trip": through_enriched(select="SELECT * FROM enriched"),
    "fact_trip": through_enriched(FACT, select="SELECT * FROM fact"),
    **{
        name: through_enriched(cte, select=f"SELECT * FROM {name}")
        for name, cte in DIMENSIONS.items()
    },
    **{name: mart_sql(name) for name in MARTS},
    "time_range_replace": _REPLACED,
    "time_range_replace_day": _REPLACED,
    "env_isolation": through_enriched(select=_ISOLATION),
    "distinct_by_span": through_enriched(select=_SPANS),
    "mart_before_rerun": through_enriched(select=_BEFORE_RERUN),
    "full_refresh": through_enriched(DIMENSIONS["dim_date"], select="SELECT * FROM dim_date"),
    "upsert_by_key": """
SELECT user_id AS id, arg_max(event_type, (early, ts, event_type)) AS name,
 max_by(ts, (early, ts)) AS created_at
FROM (SELECT *, ts < TIMESTAMP '2024-01-16 00:00:00' AS early FROM events) e GROUP BY user_id""",
    "publish_env": through_enriched(
        select="SELECT DISTINCT 'first' AS environment, pickup_date AS date_key FROM enriched"
        f" WHERE pickup_date {_EARLY}"
        " UNION ALL SELECT DISTINCT 'second', pickup_date FROM enriched"
    ),
    "daily_run": through_enriched(
        *DIMENSIONS.values(),
        select=_union(
            f"SELECT '{model}' AS model, count(*) AS row_count FROM ({rows}) t"
            for model, rows in _MODEL_COUNTS.items()
        ),
    ),
    **{f"daily_run_{name}": mart_sql(name) for name in MARTS},
    "published_base": chain(
        RAW,
        base(),
        select="SELECT count(*) AS row_count, avg(passenger_count) AS avg_passenger_count FROM base",
    ),
    "two_windows": chain(
        RAW, base("1997-01-01", "1999-12-31"), select=f"SELECT * FROM base WHERE {_RERUN}"
    ),
    "schema_contract": chain(RAW, select=_contract()),
    "output_shapes": _shapes(),
    "box_trips": chain(
        RAW,
        base(),
        select="SELECT CAST(date_trunc('day', tpep_pickup_datetime) AS TIMESTAMP) AS day,"
        " count(*) AS row_count FROM base WHERE pickup_latitude BETWEEN 40.60 AND 40.75"
        " AND pickup_longitude BETWEEN -74.20 AND -74.00 GROUP BY 1",
    ),
    "fk_audit": through_enriched(select=_audit()),
    "trip_key_duplicates": through_enriched(
        FACT,
        select="SELECT count(*) AS trips, count(DISTINCT trip_key) AS distinct_keys,"
        " count(*) - count(DISTINCT trip_key) AS duplicate_trips FROM fact",
    ),
    "count_trips": chain(RAW, base(), select="SELECT count(*) AS row_count FROM base"),
    "avg_passengers": chain(
        RAW, base(), select="SELECT avg(passenger_count) AS avg_passenger_count FROM base"
    ),
    "trips_per_day": chain(
        RAW,
        base(),
        select="SELECT CAST(date_trunc('day', tpep_pickup_datetime) AS TIMESTAMP) AS day,"
        " count(*) AS row_count FROM base GROUP BY 1",
    ),
    "head_trips": chain(
        RAW,
        base(),
        select="SELECT * FROM base ORDER BY tpep_pickup_datetime NULLS FIRST, "
        + ", ".join(f"{c} NULLS FIRST" for c in _COLUMNS if c != "tpep_pickup_datetime")
        + " LIMIT 10",
    ),
    "table_profile": chain(RAW, select=_profile(_COLUMNS, "raw", 8, 6)),
    "fact_profile": through_enriched(FACT, select=_profile(_FACT_COLUMNS, "fact", 6, 4)),
    "group_size_window": "SELECT event_id, event_type,"
    " count(*) OVER (PARTITION BY event_type) AS name_count FROM events",
    "global_row_number": "SELECT event_id, event_type, ts,"
    " row_number() OVER (ORDER BY ts, event_id) AS row_num FROM events",
    "schema_rows": chain(RAW, select=_schema_rows()),
    "catalog_tables": _union(
        f"SELECT 'given' AS namespace, '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in _TABLES
    ),
    "csv_ingest_report": chain(
        RAW,
        select="SELECT if(tpep_pickup_datetime < DATE '1998-06-01', 'trips_1', 'trips_2')"
        " AS table_name, count(*) AS row_count,"
        " count(*) FILTER (WHERE improvement_surcharge IS NULL) AS corrupt_rows,"
        " 1::BIGINT AS wrong_headers,"
        " count(improvement_surcharge) AS accepted_rows, 0::BIGINT AS differing_rows"
        " FROM raw GROUP BY 1",
    ),
    "source_parity": chain(
        RAW,
        base(),
        select="SELECT unnest(['parquet', 'orc']) AS backend, row_count, avg_passenger_count,"
        " 0::BIGINT AS differing_rows FROM (SELECT count(*) AS row_count,"
        " avg(passenger_count) AS avg_passenger_count FROM base) t",
    ),
}
