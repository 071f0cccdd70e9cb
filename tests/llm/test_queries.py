"""Every corpus query with SQL against DuckDB, on the smallest tables."""

import os

import pytest

from corvane.llm import queries
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    return oracle.views()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert oracle.same(con, queries.queries()[name], queries.oracle_sql()[name], spark) > 0


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
