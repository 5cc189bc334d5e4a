from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cabmill.plans import daily_run as D
from cabmill.registry import _store
from tests.test_expressions import trip_rows


def at(day, hour=8, **change):
    pickup = datetime(2015, 1, day, hour)
    return {
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": pickup.replace(minute=30),
        **change,
    }


def daily(store):
    rows = store.read("mart.analytics_daily_summary").orderBy("trip_date").collect()
    return [(r.trip_date.day, r.total_trips, r.total_revenue) for r in rows]


@pytest.mark.parametrize("stored", [D.ROW_MODELS, (D.ENRICHED, D.FACT)])
def test_a_rerun_of_one_day_replaces_that_day_everywhere(spark, stored):
    store = _store(spark)
    first = trip_rows(spark, at(1), at(2), at(2, 9), at(3), at(3, passenger_count=0))
    january = date(2015, 1, 1), date(2015, 1, 31)
    D.run(store, [first], *january, stored=stored)
    assert daily(store) == [(1, 1, 13.3), (2, 2, 26.6), (3, 1, 13.3)]

    late = trip_rows(spark, at(2, total_amount=20.0, vendorid=None), at(3, total_amount=99.0))
    D.run(store, [late], date(2015, 1, 2), date(2015, 1, 2), stored=stored)
    assert daily(store) == [(1, 1, 13.3), (2, 1, 20.0), (3, 1, 13.3)]
    vendors = store.read("mart.analytics_vendor_performance")
    assert sorted(r.trip_date.day for r in vendors.collect()) == [1, 3]
    assert store.read(D.FACT).groupBy("date_key").count().count() == 3
    assert store.read("mart.dim_time").count() == 1  # nine o'clock is gone

    # A day that lost all its trips leaves every model.
    D.run(store, [late.limit(0)], date(2015, 1, 3), date(2015, 1, 3), stored=stored)
    assert daily(store) == [(1, 1, 13.3), (2, 1, 20.0)]
    assert store.read("mart.dim_date").count() == 2
    if D.BASE in stored:
        assert store.read(D.BASE).count() == 2
        assert len(store.read(D.BASE).columns) == len(store.read(D.CLEANED).columns) == 19
    assert len(store.read(D.ENRICHED).columns) == len(store.read(D.FACT).columns) == 33


def test_marts_need_the_fact_table(spark):
    with pytest.raises(ValueError):
        D.run(_store(spark), [], date(2015, 1, 1), date(2015, 1, 1), stored=[D.BASE])


def test_two_raw_tables_keep_duplicates(spark):
    store = _store(spark)
    rows = trip_rows(spark, at(1))
    D.run(store, [rows, rows], date(2015, 1, 1), date(2015, 1, 1))
    assert daily(store) == [(1, 2, 26.6)]
    assert store.read(D.FACT).agg(F.count_distinct("trip_key")).first()[0] == 1


def test_a_run_uses_short_methods(spark, monkeypatch):
    limit, seen, cells = "spark.sql.codegen.hugeMethodLimit", [], D.marts.trip_cells
    before = spark.conf.get(limit)
    monkeypatch.setattr(D.marts, "trip_cells", lambda fact: seen.append(spark.conf.get(limit)) or cells(fact))
    D.run(_store(spark), [trip_rows(spark, at(1), at(2))], date(2015, 1, 1), date(2015, 1, 31))
    assert int(seen[0]) <= 8000 and spark.conf.get(limit) == before


def test_stored_files_are_packed_tightly(spark):
    store = _store(spark)
    D.run(store, [trip_rows(spark, at(1), at(2))], date(2015, 1, 1), date(2015, 1, 31))
    for model in (D.BASE, D.FACT, "mart.analytics_distance_cohort"):
        files = store.read(model).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)
