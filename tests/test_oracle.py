"""Every registered query against its SQL on the same files."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import differences, duck
from dealglass.catalog.oracle import all_sql
from dealglass.catalog.queries import all_queries

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_same_result(spark, con, name):
    sql = all_sql()[name]
    assert differences(all_queries()[name](spark, FOLDER), con, sql) == []


def test_entry(spark):
    result = entry_point.entry(spark)
    assert "risk_score" in result.columns and result.count() > 0
