from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from rowharbor.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(memory="6g", app="tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def put(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in saved.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
