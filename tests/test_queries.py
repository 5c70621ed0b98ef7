"""Every registered query against its SQL, on the smallest generated tables."""

import os

import pytest
from compare import connect, difference
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from vitalgrid.plans.catalog import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no generated tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SMALL, name, queries(), oracle_sql()) is None


def test_entry(spark):
    assert entry(spark).count() > 0
