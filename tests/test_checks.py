"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
