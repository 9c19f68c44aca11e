"""Every registered query against its DuckDB oracle on sf0.01 (the driver's gate)."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck
from vitrine.queries import QUERIES

SF = os.environ.get("VITRINE_TEST_SF", "/root/testdata/sf0.01")
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# the queries of the training-data operators are tested beside them
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, f"{name} has no oracle"
    ok, ns, nd, _, detail = compare(spark, con, name, E.queries()[name], ORACLE[name], SF)
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ID_CATALOG" in df.columns
