"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) is None
    else:
        assert len(df.columns) > 0
        df.limit(5).collect()


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
