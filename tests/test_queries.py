"""Every registered query against its check SQL on the smallest test data."""

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) is None


def test_checks_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert [r[0] for r in entry.entry(spark).orderBy("trial_id").collect()] == ["A", "B", "C"]
