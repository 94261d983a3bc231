"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from suite.check import compare, database
from suite.oracle import ORACLE
from suite.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert compare(spark, db, name, SF_DIR) == ""


def test_entry_points(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns[:3] == ["list_id", "location_id", "bucket"] and df.count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys() and QUERIES.keys() <= entry.oracle_sql().keys()
