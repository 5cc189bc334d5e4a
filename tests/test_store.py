from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cabmill.registry import _beside, _store
from cabmill.sinks.store import Store, last_per_key
from cabmill.sources.shared import child_folders

MODEL = "mart.days"


def days(spark, *rows):
    return spark.createDataFrame([(date.fromisoformat(d), n) for d, n in rows], "d DATE, n INT")


def held(store):
    return sorted((str(r.d), r.n) for r in store.read(MODEL).collect())


@pytest.mark.parametrize("write", ["replace_interval", "replace_days"])
def test_replace_interval(spark, write):
    store = _store(spark)

    def replace(start, end, *rows):
        getattr(store, write)(
            MODEL, days(spark, *rows), "d", date.fromisoformat(start), date.fromisoformat(end)
        )

    replace("2015-01-01", "2015-03-31", ("2015-01-05", 1), ("2015-02-05", 2), ("2015-03-05", 3))
    full = held(store)
    replace("2015-01-01", "2015-03-31", ("2015-01-05", 1), ("2015-02-05", 2), ("2015-03-05", 3))
    assert held(store) == full  # a re-run changes nothing

    # Neighbours of the interval stay; days without new rows go.
    replace("2015-01-10", "2015-03-04", ("2015-01-20", 4))
    assert held(store) == [("2015-01-05", 1), ("2015-01-20", 4), ("2015-03-05", 3)]

    # Batch rows outside the interval are not taken.
    replace("2015-03-01", "2015-03-31", ("2015-03-06", 5), ("2015-01-20", 9))
    assert held(store) == [("2015-01-05", 1), ("2015-01-20", 4), ("2015-03-06", 5)]

    # An interval without any row empties exactly its days.
    replace("2015-01-20", "2015-01-20")
    assert held(store) == [("2015-01-05", 1), ("2015-03-06", 5)]
    assert store.read(MODEL).columns == ["d", "n"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    store.drop()


def failing(spark, day):
    return spark.sql(f"SELECT DATE '{day}' AS d, CAST(raise_error('no') AS INT) AS n")


@pytest.mark.parametrize("write", ["replace_interval", "replace_days"])
def test_a_failed_write_leaves_all_other_days(spark, write):
    store = _store(spark)
    january = date(2015, 1, 1), date(2015, 1, 31)
    rows = [(f"2015-01-{d:02d}", d) for d in range(1, 32)]
    getattr(store, write)(MODEL, days(spark, *rows), "d", *january)
    with pytest.raises(Exception, match="no"):
        getattr(store, write)(MODEL, failing(spark, "2015-01-10"), "d", date(2015, 1, 10), date(2015, 1, 12))
    assert set(held(store)) == set(rows)


def test_a_write_killed_half_way_leaves_the_old_interval_whole(spark, monkeypatch):
    store = _store(spark)
    january = date(2015, 1, 1), date(2015, 1, 31)
    rows = [(f"2015-01-{d:02d}", d) for d in range(1, 32)]
    store.replace_interval(MODEL, days(spark, *rows), "d", *january)
    first = store.published(MODEL)
    folders = set(child_folders(spark, f"{store.location}/data"))
    # One task has written its day when the other fails.
    half = days(spark, ("2015-01-10", 99)).coalesce(1).unionByName(failing(spark, "2015-01-11"))
    with pytest.raises(Exception, match="no"):
        store.replace_interval(MODEL, half, "d", date(2015, 1, 10), date(2015, 1, 12), clustered=True)
    assert held(store) == rows and set(child_folders(spark, f"{store.location}/data")) == folders
    # Killed when all is written, but not published.
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(Store, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        store.replace_interval(MODEL, days(spark, ("2015-01-10", 99)), "d", date(2015, 1, 10), date(2015, 1, 12))
    assert held(store) == rows and store.published(MODEL) == first
    # A reader that began before a replace goes on with what it saw.
    seen = spark.table(store.view(MODEL))
    store.replace_interval(MODEL, days(spark, ("2015-01-10", 99)), "d", date(2015, 1, 10), date(2015, 1, 12))
    assert sorted(r.n for r in seen.collect()) == list(range(1, 32))
    assert sorted(r.n for r in store.read(MODEL).collect()) == [*range(1, 10), *range(13, 32), 99]


def test_only_the_days_of_the_interval_are_written(spark):
    store = _store(spark)
    january = date(2015, 1, 1), date(2015, 1, 31)
    store.replace_interval(MODEL, days(spark, *((f"2015-01-{d:02d}", d) for d in range(1, 32))), "d", *january)
    before = store.parts(store.published(MODEL))
    store.replace_interval(MODEL, days(spark, ("2015-01-10", 99)), "d", date(2015, 1, 10), date(2015, 1, 12))
    after = store.parts(store.published(MODEL))
    assert {d for d in before if after.get(d) != before[d]} == {"2015-01-10", "2015-01-11", "2015-01-12"}
    assert len(after) == 29 and after["2015-01-10"] != before["2015-01-10"]


def test_states_can_be_kept_and_read_by_name(spark):
    store = _store(spark)
    one = date(2015, 1, 1), date(2015, 1, 1)
    writes = {
        "mart.a": lambda n: store.refresh("mart.a", days(spark, ("2015-01-01", n))),
        "mart.b": lambda n: store.replace_interval("mart.b", days(spark, ("2015-01-01", n)), "d", *one),
        "mart.c": lambda n: store.upsert("mart.c", days(spark, ("2015-01-01", n)), ["d"]),
    }
    for model, write in writes.items():
        names = [write(1)]
        store.keep(model, "before")
        names += [write(n) for n in (2, 3, 4)]
        assert store.versions(model) == names
        store.drop_old_versions(model, keep=1)
        assert store.versions(model) == [names[0], names[3]]
        assert [r.n for r in store.read(model).collect()] == [4]
        for at in ("before", names[0]):
            assert [r.n for r in store.read(model, at).collect()] == [1]
        store.forget(model, "before")
        store.drop_old_versions(model, keep=1)
        assert store.versions(model) == names[3:] and [r.n for r in store.read(model).collect()] == [4]
    assert {f.split("__v")[0] for f in child_folders(spark, f"{store.location}/data")} == {
        f"{store.env}__mart__b", f"{store.env}__mart__c"
    }
    with pytest.raises(ValueError, match="not published"):
        store.keep("mart.none", "x")


def test_two_writers_take_two_numbers(spark):
    store = _store(spark)
    names = [store._new_version(MODEL) for _ in range(3)]
    assert [n.rsplit("__v", 1)[1][:6] for n in names] == ["000001", "000002", "000003"]


def test_columns_are_matched_by_name(spark):
    store = _store(spark)
    day = date(2015, 1, 1), date(2015, 1, 1)
    row = spark.sql("SELECT DATE '2015-01-01' AS d, 1 AS x, 2 AS y")
    for write in (store.replace_interval, store.replace_days):
        model = f"mart.{write.__name__}"
        write(model, row, "d", *day)
        write(model, row.select("y", "d", "x"), "d", *day)
        assert store.read(model).select("x", "y").collect() == [(1, 2)]
        for wrong in (row.drop("y"), row.withColumn("z", F.lit(1)), row.withColumn("y", F.lit("2"))):
            with pytest.raises(ValueError, match="columns differ"):
                write(model, wrong, "d", *day)


def test_environments_do_not_share_data(spark):
    first = _store(spark)
    second = _beside(first, "b")
    day = date(2015, 1, 1), date(2015, 1, 1)
    first.replace_interval(MODEL, days(spark, ("2015-01-01", 1), ("2015-01-02", 7)), "d", day[0], date(2015, 1, 2))
    second.replace_interval(MODEL, days(spark, ("2015-01-01", 5)), "d", *day)
    assert held(first) == [("2015-01-01", 1), ("2015-01-02", 7)] and held(second) == [("2015-01-01", 5)]
    third = _beside(first, "c")
    third.fork(first, [MODEL])
    assert held(third) == held(first)
    third.replace_interval(MODEL, days(spark, ("2015-01-01", 999)), "d", *day)
    assert held(third) == [("2015-01-01", 999), ("2015-01-02", 7)]
    assert held(first) == [("2015-01-01", 1), ("2015-01-02", 7)]

    def upsert(store, key, name):
        store.upsert("staging.t", spark.createDataFrame([(key, name)], "id INT, name STRING"), ["id"])
        return sorted(tuple(r) for r in store.read("staging.t").collect())

    assert upsert(first, 1, "a") == [(1, "a")]
    assert upsert(second, 2, "b") == [(2, "b")]
    assert upsert(first, 3, "c") == [(1, "a"), (3, "c")]


def test_production_must_be_named(spark):
    assert Store(spark, "/nowhere").view(MODEL).startswith("mart__dev_")
    assert Store(spark, "/nowhere", "prod").view(MODEL) == MODEL


def test_views_switch_together(spark):
    store = _store(spark)
    store.refresh("mart.a", days(spark, ("2015-01-01", 1)))
    with pytest.raises(ZeroDivisionError), store.one_switch():
        store.refresh("mart.a", days(spark, ("2015-01-01", 2)))
        assert store.read("mart.a").first().n == 2
        1 / 0
    assert store.read("mart.a").first().n == 1
    with store.one_switch():
        store.refresh("mart.a", days(spark, ("2015-01-01", 3)))
        assert spark.table(store.view("mart.a")).first().n == 1
    assert store.read("mart.a").first().n == 3


def test_published_dates_are_pruned(spark, capsys):
    store = _store(spark)
    rows = days(spark, ("2015-01-01", 1), ("2015-01-02", 2))
    store.replace_interval(MODEL, rows, "d", date(2015, 1, 1), date(2015, 1, 2))
    store.read(MODEL).where("d = DATE '2015-01-02'").explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(d" in plan and "2015-01-02" in plan.split("PartitionFilters")[1]


def test_a_hot_day_is_written_by_several_tasks(spark):
    store = _store(spark)
    rows = spark.range(0, 400000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("2015-01-01"))
        .otherwise(F.date_add(F.lit("2015-01-02").cast("date"), (F.col("id") % 20).cast("int")))
        .cast("date")
        .alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("n"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "1m")
        store.replace_interval(MODEL, rows, "d", date(2015, 1, 1), date(2015, 1, 31))
    finally:
        spark.conf.set(name, before)
    files = store.read(MODEL).select("d", F.input_file_name().alias("file")).distinct()
    by_day = {str(r.d): r["count"] for r in files.groupBy("d").count().collect()}
    assert by_day["2015-01-01"] > 2 and store.read(MODEL).count() == 400000


def test_a_box_reads_fewer_row_groups_of_a_curve(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    import pyarrow.parquet as pq

    from cabmill.functions.expressions import on_curve

    store = _store(spark)
    rows = spark.range(0, 60_000, 1, 4).selectExpr(
        "DATE '2015-01-01' AS d", "id", "rand(1) * 10 AS x", "if(id % 1000 = 0, NULL, rand(2) * 10) AS y"
    )
    curve = on_curve({"x": (0.0, 10.0), "y": (0.0, 10.0)})
    day = date(2015, 1, 1), date(2015, 1, 1)
    box, groups = "x BETWEEN 2 AND 3 AND y BETWEEN 6 AND 7", {}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    try:
        conf.set("parquet.block.size", str(16 * 1024))
        conf.set("parquet.page.size", str(4 * 1024))
        for model, expression in (("mart.plain", None), ("mart.curve", curve)):
            store.replace_interval(model, rows, "d", *day, curve=expression)
            read = total = 0
            for folder in store.parts(store.published(model)).values():
                for file in Path(urlparse(folder).path).glob("*.parquet"):
                    meta = pq.ParquetFile(file).metadata
                    for g in range(meta.num_row_groups):
                        columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(3)}
                        total += 1
                        read += columns["x"].min <= 3 and columns["x"].max >= 2 and columns["y"].min <= 7 and columns["y"].max >= 6
            groups[model] = read / total
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.size")
    assert groups["mart.plain"] == 1.0 and groups["mart.curve"] < 0.4, groups
    want = rows.where(box).count()
    assert store.read("mart.curve").where(box).count() == store.read("mart.plain").where(box).count() == want
    assert store.read("mart.curve").columns == ["d", "id", "x", "y"] and store.read("mart.curve").count() == 60_000


def test_old_versions_go_unless_a_view_reads_them(spark):
    first = _store(spark)
    second = _beside(first, "b")
    first.refresh(MODEL, days(spark, ("2015-01-01", 1)))
    second.fork(first, [MODEL])
    for n in (2, 3, 4):
        first.refresh(MODEL, days(spark, ("2015-01-01", n)))
    assert len(first.versions(MODEL)) == 4
    first.drop_old_versions(MODEL, keep=1)
    assert len(first.versions(MODEL)) == 2
    assert held(first) == [("2015-01-01", 4)] and held(second) == [("2015-01-01", 1)]


def test_output_shape_is_checked_before_a_write(spark):
    store = _store(spark)
    with pytest.raises(ValueError, match="duplicate"):
        store.refresh(MODEL, spark.range(1).select("id", F.col("id").alias("ID")))
    with pytest.raises(ValueError, match="unnamed"):
        store.refresh(MODEL, spark.range(1).select(F.col("id") + 1))
    assert store.versions(MODEL) == []


def test_upsert(spark):
    store = _store(spark)

    def people(*rows):
        return spark.createDataFrame(rows, "id INT, name STRING, created_at TIMESTAMP_NTZ")

    def upsert(*rows):
        store.upsert("staging.hello", people(*rows), ["id"], ["created_at"])
        return sorted((r.id or 0, r.name) for r in store.read("staging.hello").collect())

    t1, t2, t3 = (datetime(2015, 1, d) for d in (1, 2, 3))
    assert upsert((1, "a", t1), (2, "b", t1), (None, "n", t1)) == [(0, "n"), (1, "a"), (2, "b")]
    # Within a batch the latest row wins; across batches the later batch wins.
    assert upsert((2, "old", t1), (2, "new", t3), (3, "c", t1), (None, "m", t1)) == [
        (0, "m"), (1, "a"), (2, "new"), (3, "c"),
    ]
    assert upsert((2, "back", t2)) == [(0, "m"), (1, "a"), (2, "back"), (3, "c")]
    # A literal row as the batch, stamped with the current time.
    hello = spark.sql("SELECT 1 AS id, 'hello' AS name, localtimestamp() AS created_at")
    store.upsert("staging.hello", hello, ["id"], ["created_at"])
    row = store.read("staging.hello").where("id = 1").first()
    assert row.name == "hello" and row.created_at > t3


def test_an_upsert_writes_the_touched_buckets_only(spark):
    store, model = _store(spark), "staging.people"
    people = spark.range(2000).selectExpr("if(id = 7, NULL, id) AS id", "CAST(id AS STRING) AS name")
    store.upsert(model, people, ["id"], buckets=16)
    before = store.parts(store.published(model))
    assert len(before) == 16
    change = spark.sql("SELECT 42L AS id, 'new' AS name")
    store.upsert(model, change, ["id"])  # the table keeps its number of buckets
    after = store.parts(store.published(model))
    assert after.keys() == before.keys() and sum(after[b] != before[b] for b in after) == 1
    assert len(child_folders(spark, after[next(b for b in after if after[b] != before[b])].rsplit("/", 1)[0])) == 1
    rows = {r.id: r.name for r in store.read(model).collect()}
    assert len(rows) == 2000 and rows[42] == "new" and rows[41] == "41" and rows[None] == "7"
    # The merge reads the touched bucket alone.
    store.upsert(model, spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 'none' AS name"), ["id"])
    assert store.read(model).where("id IS NULL").collect() == [(None, "none")]
    # Another key: the whole table is dealt anew.
    store.upsert(model, spark.sql("SELECT 1L AS id, 'new' AS name"), ["name"], buckets=4)
    assert len(store.parts(store.published(model))) == 4
    assert sorted(r.id for r in store.read(model).where("name IN ('new', '41')").collect()) == [1, 41]
    empty = spark.sql("SELECT 1L AS id, 'new' AS name").limit(0)
    store.upsert(model, empty, ["name"])
    assert store.read(model).count() == 2000
    # A table of another kind becomes bucketed with its first upsert.
    store.refresh("staging.b", people)
    store.upsert("staging.b", change, ["id"], buckets=8)
    assert store.read("staging.b").count() == 2000 and len(store.parts(store.published("staging.b"))) == 8


def test_last_per_key_with_a_hot_key(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    got = {r.k: r.v for r in last_per_key(rows, ["k"], ["v"]).collect()}
    assert got[-1] == 29997 and len(got) == 20001
