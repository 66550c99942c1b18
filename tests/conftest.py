from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from topiclake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Every key with more than a handful of rows counts as hot."""
    spark.conf.set("spark.topiclake.rowsPerTask", "12")
    yield
    spark.conf.unset("spark.topiclake.rowsPerTask")


@pytest.fixture
def path(spark):
    from topiclake.plans.workspace import new_dir

    return lambda purpose="test": new_dir(spark, purpose)
