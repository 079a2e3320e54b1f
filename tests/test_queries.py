"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import connect, difference

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_matches_sql(spark, con, name):
    problem, n = difference(spark, con, driver.queries()[name], driver.oracle_sql().get(name), FOLDER)
    assert not problem
    assert n >= 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    assert not driver.entry(spark).isEmpty()
