import pytest

import __spark_entry__ as driver
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, small, con, name):
    assert difference(spark, con, small, name) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 386
