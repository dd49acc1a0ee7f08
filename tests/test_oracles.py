"""Every query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], ORACLES[name], SF_DIR) == ""


def test_queries_without_sql(spark):
    for name in set(entry.queries()) - set(ORACLES):
        assert spark_rows(entry.queries()[name](spark, SF_DIR))[2]


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["bin", "n_tokens", "weighted_sum", "n_trained"] and rows.count() > 0


def test_transforms_all_have_queries():
    from chatloom.operators.registry import transform_names

    names = {n.split("_", 1)[1] for n in entry.queries() if n[0] == "t" and n[1:3].isdigit()}
    assert len(names) == 26 and names <= set(transform_names())
