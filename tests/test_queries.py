"""Every registered query against its SQL twin in DuckDB."""

import pytest

from workloads.compare import compare, connect
from workloads.oracle import ORACLE
from workloads.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_driver_contract(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() == 150
