"""Every query that has SQL agrees with it on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import connect, differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"no tables in {FOLDER}")
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER) == []


def test_names_and_entry(spark, con):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
