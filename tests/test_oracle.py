"""Every registered query with SQL gives the same rows in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    ok, rows, message = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, message
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
