"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
OWN = sorted(q for q in E.queries() if q.startswith("q"))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    msg, ok = compare(spark, con, name, E.queries()[name], sql, SF)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entity_id", "feature_name", "feature_value", "window_start",
                          "window_end", "computed_at"]
