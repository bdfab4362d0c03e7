"""Every registered query against its reference SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as driver
from shelfscan.catalog.queries import QUERIES
from tests.oracle import compare, connect

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_reference_sql():
    assert set(NAMES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_reference_sql(spark, connection, sf_dir, name):
    problem = compare(
        spark, connection, driver.queries()[name], driver.oracle_sql()[name], sf_dir)
    assert problem is None, problem


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows[0].ttm_sales >= rows[-1].ttm_sales
