from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from subscope.session import local_session  # noqa: E402

SF = os.environ.get("SUBSCOPE_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table("a int, b string", (1, "x"), ...)``: a small DataFrame."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip(f"no test data at {SF}")
    return SF
