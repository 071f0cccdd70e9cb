"""Every registered linkage query with SQL against DuckDB, on the smallest tables."""

import os

import pytest

from corvane.plans import linkage_queries
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    return oracle.views()


@pytest.mark.parametrize("name", sorted(linkage_queries.oracle_sql()))
def test_equals_sql(spark, con, name):
    assert oracle.same(con, linkage_queries.queries()[name], linkage_queries.oracle_sql()[name], spark) > 0


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "matched_entity_ids" in out.columns
