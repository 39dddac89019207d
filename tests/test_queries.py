"""Every registered query against its SQL on the smallest given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from lakemart.queries import QUERIES
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert difference(name, spark, FOLDER, connection) is None
