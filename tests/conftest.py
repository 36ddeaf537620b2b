import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("MILLRACE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)
