"""Properties of the marts, on data that has NULL vendors and payment types."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from cabmill.functions.measures import MEASURES
from cabmill.operators import dimensions, marts, trips
from cabmill.registry import QUERIES, _enriched
from tests.test_expressions import trip_rows


def explained(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def star(spark):
    enriched = _enriched(spark, "/root/testdata/sf0.01").cache()
    return enriched, trips.fact_trip(enriched)


@pytest.mark.parametrize(
    "mart, share",
    [
        ("vendor_performance", "market_share_pct"),
        ("payment_method", "payment_method_share_pct"),
        ("distance_cohort", "trip_share_pct"),
    ],
)
def test_shares_sum_to_100(spark, mart, share):
    sums = QUERIES[mart](spark, "/root/testdata/sf0.01").groupBy("trip_date").agg(
        F.sum(share).alias("s")
    )
    assert sums.where("abs(s - 100) > 1e-9").count() == 0


def test_null_keys_leave_only_the_joined_marts(spark, star):
    enriched, _ = star

    def trips_of(mart):
        return (
            QUERIES[mart](spark, "/root/testdata/sf0.01").agg(F.sum("total_trips")).first()[0]
        )

    every = enriched.count()
    null_vendors = enriched.where("vendorid IS NULL").count()
    null_payments = enriched.where("payment_type IS NULL").count()
    assert null_vendors > 0 and null_payments > 0
    assert trips_of("daily_summary") == trips_of("hourly_pattern") == every
    assert trips_of("distance_cohort") == every
    assert trips_of("vendor_performance") == every - null_vendors
    assert trips_of("payment_method") == every - null_payments


def test_one_cell_table_serves_every_mart(spark, star):
    enriched, fact = star
    cells = marts.trip_cells(fact).cache()
    days, hours = dimensions.dim_date(enriched), dimensions.dim_time(enriched)
    from_cells = {
        "daily_summary": marts.daily_summary(cells, days),
        "hourly_pattern": marts.hourly_pattern(cells, hours, days),
        "vendor_performance": marts.vendor_performance(cells, dimensions.dim_vendor(enriched)),
        "payment_method": marts.payment_method(cells, dimensions.dim_payment_type(enriched)),
        "distance_cohort": marts.distance_cohort(cells),
    }
    ratios = {"avg_speed_mph", "avg_fare_per_mile", "avg_revenue_per_minute", "avg_tip_percentage"}
    for name, mart in from_cells.items():
        rounded = mart.select(
            *(F.round(c, 6).alias(c) if c in ratios else F.col(c) for c in mart.columns)
        )
        want = QUERIES[name](spark, "/root/testdata/sf0.01")
        assert rounded.exceptAll(want).isEmpty() and want.exceptAll(rounded).isEmpty(), name


def test_means_skip_nulls_and_sums_stay_null(spark):
    rows = trip_rows(
        spark, {"tip_amount": None}, {"tip_amount": 3.0}, {"tip_amount": None, "vendorid": 2}
    )
    enriched = trips.enriched_trip(rows)
    mart = marts.vendor_performance(
        marts.partials_for("vendor_performance", trips.fact_trip(enriched)),
        dimensions.dim_vendor(enriched),
    )
    one, two = mart.orderBy("vendor_key").collect()
    assert (one.total_trips, one.total_tips, one.avg_tip_amount) == (2, 3.0, 3.0)
    assert (two.total_trips, two.total_tips, two.avg_tip_amount) == (1, None, None)
    assert one.market_share_pct == pytest.approx(200 / 3)


def test_fixed_point_sums_do_not_depend_on_order(spark):
    values = spark.range(0, 200000, 1, 16).select((F.col("id") % 997 / 100).alias("fare_amount"))
    exact = F.expr(f"sum({MEASURES['fare'].value})")
    assert (
        values.agg(exact).first() == values.orderBy(F.desc("fare_amount")).agg(exact).first()
    )


def test_joins_need_no_hint_to_broadcast(spark, sf_dir):
    text = explained(QUERIES["hourly_pattern"](spark, sf_dir))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    from datetime import date

    from cabmill.sources.derived_trips import raw_trips
    from cabmill.sources.tables import scan

    raw_trips(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    raw = scan(spark, str(tmp_path / "raw"))
    base = trips.base_trip(raw, raw, start=date(1997, 1, 1), end=date(1997, 1, 31))
    plan = explained(trips.cleaned_trip(base).select("fare_amount"))
    scans = [part for part in plan.split("\n\n") if "PushedFilters" in part]
    assert len(scans) == 2  # both branches of the union
    for scan_text in scans:
        assert "GreaterThanOrEqual(tpep_pickup_datetime,1997-01-01T00:00)" in scan_text
        assert "GreaterThan(trip_distance,0.0)" in scan_text
        assert "tolls_amount" not in scan_text
