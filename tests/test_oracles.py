"""Every registered query against its SQL on the same tables."""

import pytest
from conftest import CHECKED
from oracle_check import compare, connect

import __spark_entry__ as driver


@pytest.fixture(scope="module")
def con():
    return connect(CHECKED)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, driver.queries()[name], driver.oracle_sql()[name], CHECKED) == ""


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    assert set(driver.entry(spark).columns) == {"antecedent", "consequent", "freq", "confidence"}
