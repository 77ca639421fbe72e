"""Every registered query with SQL gives the same rows in DuckDB on the same tables."""

import pytest

from checks.compare import compare, connect
from checks.context import Context
from checks.registry import registered

SF = "/root/testdata/sf0.001"
QUERIES = registered()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, con, name):
    fn, sql = QUERIES[name]
    status, _, _, note = compare(Context.of(spark, SF), con, name, fn, sql)
    assert status in ("ok", "rows"), note
