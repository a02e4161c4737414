"""Every registered query on Spark and, where it has SQL, on DuckDB."""

import pytest

from catalogflow.queries.registry import all_queries
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, sf, name):
    ok, message, _ = compare(spark, con, all_queries()[name], sf)
    assert ok, message
