"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from tools.check_queries import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, name):
    total, problem = compare(spark, SMALL, driver.queries()[name], driver.oracle_sql().get(name))
    assert problem is None
    assert total > 0 or "email" in name


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_names():
    assert set(driver.oracle_sql()) <= set(driver.queries())
