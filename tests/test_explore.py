"""Distributed window and profile operators against brute force, with hot keys."""

import random
import statistics
from collections import Counter
from datetime import datetime, timedelta
from math import ceil

from cabmill.operators import explore


def test_row_number_over_a_hot_value(spark):
    rng = random.Random(7)
    rows = [(rng.choice([5, 5, rng.randrange(40)]), i) for i in rng.sample(range(9000), 9000)]
    table = spark.createDataFrame(rows, "ts INT, id INT").repartition(16)
    got = explore.with_row_number(table, ["ts", "id"], "row_num").collect()
    want = {pair: i for i, pair in enumerate(sorted(rows), 1)}
    assert {(r.ts, r.id): r.row_num for r in got} == want


def test_group_size_with_null_and_hot_keys(spark):
    names = ["hot"] * 700 + [None] * 20 + [f"n{i % 50}" for i in range(300)]
    table = spark.createDataFrame(list(enumerate(names)), "id INT, name STRING")
    got = explore.with_group_size(table, ["name"], "size").collect()
    sizes = Counter(names)
    assert len(got) == len(names) and all(r["size"] == sizes[r.name] for r in got)


def test_group_size_without_broadcast(spark):
    names = ["hot"] * 700 + [f"n{i % 50}" for i in range(300)]
    table = spark.createDataFrame(list(enumerate(names)), "id INT, name STRING")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, -1)
        got = explore.with_group_size(table, ["name"], "size").collect()
    finally:
        spark.conf.set(limit, before)
    assert sum(r["size"] == 700 for r in got) == 700 and len(got) == 1000


def test_head_is_ordered(spark):
    table = spark.range(1000).selectExpr("1000 - id AS k").repartition(8)
    assert [r.k for r in explore.head(table, ["k"], 5).collect()] == [1, 2, 3, 4, 5]


def _discrete(values, share):
    ordered = sorted(values)
    return ordered[max(ceil(share * len(ordered)), 1) - 1]


def test_profile(spark):
    rng = random.Random(3)
    first = datetime(2015, 1, 1)
    rows = [
        (
            rng.choice([None, 1, 1, 1, rng.randrange(10**15, 10**18)]),
            rng.choice([None, 0.5, 0.5, rng.uniform(-1e6, 1e6)]),
            first + timedelta(microseconds=rng.randrange(10**13)) if rng.random() < 0.9 else None,
            rng.choice(["N", "Y", None]),
            None,
        )
        for _ in range(5000)
    ]
    table = spark.createDataFrame(
        rows, "a BIGINT, b DOUBLE, t TIMESTAMP_NTZ, s STRING, e DOUBLE"
    ).repartition(16)
    got = {r.column_name: r for r in explore.profile(table).collect()}
    columns = {n: [r[i] for r in rows if r[i] is not None] for i, n in enumerate("abtse")}
    for name, values in columns.items():
        assert got[name]["count"] == len(values)
        assert got[name].null_count == 5000 - len(values)
    for name in "ab":
        values, row = columns[name], got[name]
        assert abs(row.mean - statistics.fmean(values)) <= 1e-9 * max(map(abs, values))
        assert abs(row.std / statistics.stdev(values) - 1) < 1e-9
        assert (row.min, row.max) == (float(min(values)), float(max(values)))
        for quartile, share in explore.QUARTILES.items():
            assert row[quartile] == float(_discrete(values, share)), (name, quartile)
    times, row = columns["t"], got["t"]
    assert (row.min_ts, row.max_ts) == (min(times), max(times)) and row.std is None
    for quartile, share in explore.QUARTILES.items():
        assert row[f"{quartile}_ts"] == _discrete(times, share)
    micros = sum((t - first) // timedelta(microseconds=1) for t in times) // len(times)
    assert row.mean_ts == first + timedelta(microseconds=micros)
    assert (got["s"].min_text, got["s"].max_text, got["s"].min) == ("N", "Y", None)
    assert got["e"]["count"] == 0 and got["e"].q50 is None and got["e"].mean is None


def test_approximate_profile_is_close(spark):
    table = spark.range(100000).selectExpr("CAST(id AS DOUBLE) AS x", "'a' AS s")
    row = explore.profile(table, exact=False).where("column_name = 'x'").first()
    assert abs(row.q25 - 25000) < 50 and abs(row.q75 - 75000) < 50 and row.max == 99999.0


def counting(spark, table):
    """The table, read through a step that counts the rows it passes on."""
    passed = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    return table.mapInArrow(run, table.schema), passed


def test_quartiles_on_the_border_of_tied_values_take_two_scans(spark):
    columns = {
        "tied": "CAST(id % 8 AS INT)", "real": "CAST(id % 4 AS DOUBLE)",
        "between": "CASE WHEN id % 1000 < 499 THEN 1 WHEN id % 1000 = 499 THEN 2 + id DIV 1000 ELSE 900000 END",
        "constant": "5L", "own": "id * 7919 % 200003", "fine": "sqrt(id)", "day": "DATE '2015-01-01' + CAST(id % 9 AS INT)",
        "none": "CAST(NULL AS INT)", "few": "if(id < 3, id, NULL)",
    }
    table = spark.range(0, 200_000, 1, 9).selectExpr(*(f"{e} AS `{c}`" for c, e in columns.items()))
    rows = table.collect()
    counted, passed = counting(spark, table)
    got = {r.column_name: r for r in explore.profile(counted).collect()}
    assert passed.value == 2 * 200_000
    for name in set(columns) - {"day", "none"}:
        for quartile, share in explore.QUARTILES.items():
            values = [r[name] for r in rows if r[name] is not None]
            assert got[name][quartile] == float(_discrete(values, share)), (name, quartile)
    for quartile, share in explore.QUARTILES.items():
        assert got["day"][f"{quartile}_ts"].date() == _discrete([r.day for r in rows], share)
    assert got["none"].q50 is None and got["none"].null_count == 200_000


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    monkeypatch.setattr(explore, "_SKETCH", 8)
    monkeypatch.setattr(explore, "_MARGIN", 1e-6)
    monkeypatch.setattr(explore, "_TASKS_TOGETHER", 2)
    table = spark.range(0, 30_000, 1, 11).selectExpr("id * 7919 % 30011 AS a", "-id / 3 AS b")
    rows = table.collect()
    got = {r.column_name: r for r in explore.profile(table).collect()}
    for name in "ab":
        for quartile, share in explore.QUARTILES.items():
            assert got[name][quartile] == float(_discrete([r[name] for r in rows], share))


def test_profile_of_odd_numbers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(nan, 1.0), (inf, None), (-inf, None), (0.0, None), (-0.0, None), (nan, None), (nan, None), (nan, None)]
    got = {r.column_name: r for r in explore.profile(spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")).collect()}
    a, b = got["a"], got["b"]
    assert (a.min, a.q25, a.q50) == (-inf, 0.0, inf) and a.q75 != a.q75 and a.max != a.max and a.mean != a.mean
    assert (b.min, b.q25, b.q50, b.q75, b.max, b.mean, b.std) == (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, None)
    empty = explore.profile(spark.createDataFrame([], "a DOUBLE, s STRING")).collect()
    assert [(r["count"], r.mean, r.q50, r.min_text) for r in empty] == [(0, None, None, None)] * 2
    assert explore.profile(spark.createDataFrame([("x",)], "s STRING")).first().max_text == "x"


def test_profile_scans_run_in_short_methods_with_plain_sums(spark, monkeypatch):
    limit, seen, write = "spark.sql.codegen.hugeMethodLimit", [], explore.Scratch.written
    before = spark.conf.get(limit)

    def spied(scratch, frame, keep=False):
        plan = frame._jdf.queryExecution().analyzed().toString()
        seen.append((int(spark.conf.get(limit)), "var_pop" in plan, "decimal" in plan))
        return write(scratch, frame, keep)

    monkeypatch.setattr(explore.Scratch, "written", spied)
    moment = "TIMESTAMP_NTZ '1960-02-03 04:05:06.000007' + INTERVAL '1' DAY * id"
    columns = "CAST(1e6 + id % 3 AS DOUBLE) AS x", "id * 3 AS n", "0.3D AS c", f"{moment} AS t"
    table = spark.range(0, 9000, 1, 5).selectExpr(*columns)
    got = {r.column_name: r for r in explore.profile(table).collect()}
    assert seen and all(size <= 8000 and not costly and not wide for size, costly, wide in seen)
    assert spark.conf.get(limit) == before
    assert abs(got["x"].std / statistics.stdev([0.0, 1.0, 2.0] * 3000) - 1) < 1e-12 and got["c"].std == 0.0
    assert abs(got["n"].std / statistics.stdev(range(0, 27_000, 3)) - 1) < 1e-12
    first = datetime(1960, 2, 3, 4, 5, 6, 7)
    assert got["t"].mean_ts == first + timedelta(days=8999) / 2 and got["t"].std is None
