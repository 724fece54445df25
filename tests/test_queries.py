"""Every registered query against its SQL twin; RIDGEWAY_TEST_SF names another folder."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from ridgeway import queries as catalog
from compare import connect, differences

SF_DIR = os.environ.get("RIDGEWAY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF_DIR)
    assert differences(df, con, catalog.oracle_sql()[name]) == []


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["alpha", "fold", "r2"] and df.count() == 15
