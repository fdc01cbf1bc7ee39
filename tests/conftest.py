import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affilix.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "affilix-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def no_broadcast(spark):
    """Every join shuffles, so that hot keys are looked for."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)
