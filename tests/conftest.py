import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dealglass.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from fixtures import small_model

    return small_model(spark)
