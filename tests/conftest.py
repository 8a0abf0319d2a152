import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollmill.plans.session import local_session  # noqa: E402

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def root():
    return ROOT


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
