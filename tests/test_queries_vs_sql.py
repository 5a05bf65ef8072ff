"""Every registered query against its SQL in DuckDB on the smallest sample."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import check_queries  # noqa: E402

from capsieve import catalog  # noqa: E402

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, message = check_queries.compare(spark, con, name, QUERIES[name], SQL[name], FOLDER)
    assert ok, message
