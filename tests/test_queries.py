"""Every query against its SQL, on the smallest set of tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from tillroll.registry.oracle import ORACLE_SQL
from tillroll.registry.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = queries()[name](spark, SMALL)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, database, sql) is None


def test_entry(spark):
    assert entry(spark).count() == 133


def test_only_iterative_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE_SQL) == {"kmeans_clusters"}
    assert set(oracle_sql()) <= set(queries())
