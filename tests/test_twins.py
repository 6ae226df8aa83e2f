"""Every registered query gives what its SQL twin gives."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registered
from tests.twins import database, differences
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = registered.queries()[name](spark, SF_DIR)
    assert differences(df, con, ORACLES[name]) == []


def test_entry(spark):
    assert registered.entry(spark).count() > 0
