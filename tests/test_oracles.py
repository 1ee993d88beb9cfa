"""Every registered query against DuckDB."""

import pytest

import __spark_entry__ as entry
from checks import oracles, queries
from checks.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracles.oracles()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(spark, duck, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "totalOrders", "totalRevenue"] and df.count() > 0
