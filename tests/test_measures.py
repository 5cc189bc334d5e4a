import math

from pyspark.sql import functions as F

from cabmill.functions.measures import distinct_cells, distinct_counts, mean, partials, roll_up, total


def tips(spark, *values):
    fact = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "k INT, tip_amount DOUBLE")
    parts = roll_up(partials(fact, ["k"], ["tip"], []), [])
    return parts.selectExpr(total("tip", "total"), mean("tip", "mean"), "rest_tip").first()


def test_finer_amounts_are_kept(spark):
    row = tips(spark, 2.0, 0.00004, 0.1, 0.2, None)
    assert math.isclose(row.total, 2.30004, rel_tol=1e-15) and math.isclose(row.mean, 2.30004 / 4)
    assert row.rest_tip == 1


def test_amounts_of_the_declared_scale_are_exact(spark):
    row = tips(spark, *([0.1, 0.2, 0.7] * 1000), -0.35)
    assert row.total == 999.65 and row.rest_tip == 0


def test_nan_and_huge_amounts_stop_nothing(spark):
    assert math.isnan(tips(spark, 1.0, float("nan")).total)
    assert tips(spark, 1.0, 1e15, 1e300).total == 1e300
    assert tips(spark, 1.0, float("inf")).total == math.inf
    assert tips(spark, None).mean is None


def test_durations_are_exact_to_the_microsecond(spark):
    fact = spark.range(3).select(F.lit(1).alias("k"), (F.lit(0.000001) / 60).alias("trip_duration_minutes"))
    row = partials(fact, ["k"], ["duration"], []).selectExpr(total("duration", "t"), "sum_duration").first()
    assert row.sum_duration == 3 and math.isclose(row.t, 3e-6 / 60)


def test_distinct_counts_add_up(spark):
    values = [(d, v) for d in range(6) for v in (None, 1, 1, d, -d, 40_000 * d, 2**40 + d % 2)]
    rows = spark.createDataFrame(values, "d INT, v BIGINT")
    cells = distinct_cells(rows, ["d"], ["v"])
    for size in (1, 2, 3, 6):
        got = distinct_counts(cells.selectExpr("d DIV {} AS g".format(size), "column_name", "bucket", "bitmap"), ["g"])
        want = {}
        for d, v in values:
            if v is not None:
                want.setdefault(d // size, set()).add(v)
        assert {r.g: r.distinct_values for r in got.collect()} == {g: len(s) for g, s in want.items()}
    assert distinct_counts(distinct_cells(rows.limit(0), ["d"], ["v"]), ["d"]).count() == 0
