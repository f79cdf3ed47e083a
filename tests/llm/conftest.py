import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import odd  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def docs(spark):
    return odd.documents(spark).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return odd.documents(spark, [])


@pytest.fixture(scope="session")
def larger():
    """Enough labelled rows to hold some out."""
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
