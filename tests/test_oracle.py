"""Every registered query equals its oracle SQL on the smallest data set."""

import pytest

from __spark_entry__ import entry
from cabmill.registry import QUERIES
from oracle.registry import ORACLE as SQL
from tests.oracle_check import difference



def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
