import duckdb
import pytest

from cabmill.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, sf_dir, name):
    with duckdb.connect() as duck:
        for table in ("documents", "embeddings", "conversations", "pages", "labels", "benchmark"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        want = duck.execute(ORACLE[name]).fetch_arrow_table() if hasattr(duck, "fetch_arrow_table") else None
        rows = duck.execute(ORACLE[name]).fetchall()
    got = QUERIES[name](spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    assert want is None or got.columns == want.column_names


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
