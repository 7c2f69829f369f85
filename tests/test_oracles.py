"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from ledgerloom.catalog import oracles, queries
from tests.oracle import compare, connect

QUERIES, SQL = queries(), oracles()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(name, spark, con, small):
    result, _ = compare(spark, con, name, QUERIES[name], SQL[name], small)
    assert result == "ok"
