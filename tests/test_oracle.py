"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as entry
from siteweave.plans.registry import ORACLES, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []
