"""Every query against its SQL on the given tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    result = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert difference(result, con, sql) is None


def test_entry(spark):
    assert entry(spark).count() > 0
