from datetime import datetime
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cabmill.operators import dimensions, quality, trips
from cabmill.schemas import RAW_TRIP
from tests.test_expressions import trip_rows


def test_contract_violations():
    assert quality.contract_violations(RAW_TRIP, RAW_TRIP) == []
    drifted = StructType(
        [f for f in RAW_TRIP if f.name not in ("extra", "vendorid")]
        + [StructField("vendorid", IntegerType()), StructField("more", IntegerType())]
    )
    assert quality.contract_violations(drifted, RAW_TRIP) == [
        ("vendorid", "bigint", "int"),
        ("extra", "double", ""),
        ("more", "", "int"),
    ]


def test_star_key_audit(spark):
    enriched = trips.enriched_trip(
        trip_rows(spark, {}, {"vendorid": None}, {"vendorid": 9}, {"ratecodeid": 99})
    )
    known = enriched.where("vendorid = 1 AND ratecodeid = 1")
    dims = {
        "dim_date": dimensions.dim_date(known),
        "dim_time": dimensions.dim_time(known),
        "dim_vendor": dimensions.dim_vendor(known),
        "dim_payment_type": dimensions.dim_payment_type(known),
        "dim_rate_code": dimensions.dim_rate_code(known),
    }
    keys = trips.fact_trip(enriched).groupBy(*quality.STAR_KEYS).agg(F.count("*").alias("trips"))
    audit = quality.star_key_audit(keys, dims).collect()
    got = {r.key: (r.trips, r.null_keys, r.orphan_keys) for r in audit}
    assert got == {
        "date_key": (4, 0, 0),
        "time_key": (4, 0, 0),
        "vendor_key": (4, 1, 1),
        "payment_type_key": (4, 0, 0),
        "rate_code_key": (4, 0, 1),
    }
    with pytest.raises(ValueError, match="trips"):
        quality.star_key_audit(trips.fact_trip(enriched), dims)
    empty = {r.key: tuple(r)[1:] for r in quality.star_key_audit(keys.limit(0), dims).collect()}
    assert empty == {}


def test_trip_key_duplicates(spark):
    fact = trips.fact_trip(trips.enriched_trip(trip_rows(spark, {}, {}, {"vendorid": 2})))
    assert tuple(quality.trip_key_duplicates(fact).first()) == (3, 2, 1)
    assert tuple(quality.trip_key_duplicates(fact.limit(0)).first()) == (0, 0, 0)


def test_table_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "b")], "a INT, b STRING")
    right = spark.createDataFrame([("b", 2), (None, 1), ("c", 3)], "b STRING, a INT")
    rows = {tuple(r) for r in quality.table_difference(left, right).collect()}
    assert rows == {(1, None, 1), (3, "c", -1)}
    assert quality.table_difference(left, left.orderBy(F.desc("a"))).isEmpty()


def test_difference_by_cell_equals_the_whole_difference(spark):
    rows = [(i, datetime(2015, 1, 1 + i % 9), None if i % 7 else 0.5 * i) for i in range(300)] + [(1, None, None)] * 3
    left = spark.createDataFrame(rows, "a INT, t TIMESTAMP_NTZ, x DOUBLE").repartition(5)
    changed = [*rows[:50], *rows[51:], (7, datetime(2015, 1, 3), 1.0), (1, None, None)]
    right = spark.createDataFrame(changed, "a INT, t TIMESTAMP_NTZ, x DOUBLE").select("x", "t", "a")
    got = quality.table_difference_by_cell(left, right, "t")
    assert sorted(map(str, got.collect())) == sorted(map(str, quality.table_difference(left, right).collect()))
    assert got.count() == 3
    cells = quality.differing_cells(left, right, [F.col("t").cast("date")]).collect()
    assert {c.cell0 and c.cell0.day for c in cells} == {6, 3, None}
    # Tables that agree: nothing but digests is shuffled.
    same = quality.table_difference_by_cell(left, left.orderBy("x"), "t")
    assert same.isEmpty() and same.columns == [*left.columns, "surplus"]
    assert "SortMergeJoin" not in same._jdf.queryExecution().toString()
    for empty in (left.limit(0), right.limit(0)):
        assert quality.table_difference_by_cell(empty, left, "t").count() == quality.table_difference(empty, left).count()
