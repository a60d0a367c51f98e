"""Every registered query equals its oracle statement on the driver's tables."""

import pytest
from compare import oracle, oracle_rows, spark_rows

import __spark_entry__ as driver
from stockflow.testbed.oracle import ORACLES
from stockflow.testbed.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_oracle(spark, sf_dir, con, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == oracle_rows(con, ORACLES[name])


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
