"""Every registered query against its DuckDB twin (sf0.001; the driver runs sf0.01)."""

import pytest

import __spark_entry__ as E
from cadence.oracle_sql import oracle_sql
from cadence.plans.catalog import QUERIES
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "user_id"
