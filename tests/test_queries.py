"""Every registered query against its checking SQL on the smallest tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF_DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
