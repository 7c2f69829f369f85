from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small() -> str:
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not mounted")
    return SMALL


@pytest.fixture(scope="session")
def make(spark):
    """DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows(df) -> set:
    return {tuple(r) for r in df.collect()}
