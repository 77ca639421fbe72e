"""Registered queries with SQL give the same rows in DuckDB on the same tables."""

import pytest

from checks.compare import connect, kind, rows_of
from earshot.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert dict((n, kind(t)) for n, t in df.dtypes) == {d[0]: kind(str(d[1])) for d in result.description}
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())
