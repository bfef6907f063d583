"""Differential test: every registered query vs its DuckDB oracle on the driver tables."""

import os

import pytest

import __spark_entry__ as entry
from ratify.plans.driver import QUERIES
from tests.oracle_check import compare, duck

SF_DIR = os.environ.get("RATIFY_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF_DIR}/orders.parquet"):
        pytest.skip("driver tables not present")
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql()[name]
    assert compare(spark, con, name, entry.queries()[name], sql, SF_DIR, verbose=False)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert "produtividade_semana_aprovador" in df.columns
    assert df.count() >= 0
