"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tollspark.plans.oracles import all_oracles
from tollspark.plans.queries import all_queries
from compare import difference, oracle_connection


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, sf_dir, connection, name):
    assert difference(all_queries()[name](spark, sf_dir), connection, all_oracles()[name]) is None
