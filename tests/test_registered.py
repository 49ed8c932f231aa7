"""Every registered query on the smallest tables; those with SQL must equal it row by row."""

import os

import pytest

from oracle_check import compare, connect, entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0
