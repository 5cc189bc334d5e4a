from pathlib import Path

import pytest

from cabmill.registry import QUERIES
from cabmill.sources.shared import Scratch, release_results, shared_dir, written


class Conf(dict):
    def get(self, name, default=None):
        return super().get(name, default)


class Session:
    def __init__(self, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})


def test_the_folder_named_by_the_session_is_used():
    path = shared_dir(Session(spark_checkpoint_dir="hdfs://x/shared/", spark_master="yarn"), "t")
    assert path.startswith("hdfs://x/shared/cabmill-t-")


def test_the_folder_must_be_named():
    for master in ("local[2]", "local-cluster[1,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(spark_master=master), "t")


def files_in(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return {p.name for p in folder.glob("cabmill-*")}


def test_written_tables_are_read_from_files(spark):
    frame = written(spark.range(10).selectExpr("id * 2 AS twice"), "test")
    assert frame.inputFiles() and frame.agg({"twice": "sum"}).first()[0] == 90


def test_scratch_tables_have_an_owner(spark):
    release_results(spark)
    before = files_in(spark)
    with pytest.raises(ZeroDivisionError), Scratch(spark, "test") as scratch:
        scratch.written(spark.range(3))
        assert len(files_in(spark) - before) == 1
        1 / 0
    assert files_in(spark) == before
    with Scratch(spark, "test") as scratch:
        kept = scratch.written(spark.range(3), keep=True)
    assert kept.count() == 3 and len(files_in(spark) - before) == 1
    assert release_results(spark) == 1 and files_in(spark) == before


@pytest.mark.parametrize("name", ["fk_audit", "table_profile", "upsert_by_key", "global_row_number"])
def test_nothing_is_left_after_a_query(spark, sf_dir, name):
    release_results(spark)
    before = files_in(spark)
    QUERIES[name](spark, sf_dir).collect()
    release_results(spark)
    assert files_in(spark) == before
