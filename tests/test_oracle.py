"""Every registered query against its DuckDB twin on the smallest test tables."""

import pytest

from devtrail.oracle import ORACLE
from devtrail.registry import QUERIES
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF, QUERIES, ORACLE)
    spark.catalog.clearCache()
    assert r["cols_match"], r
    assert r["rows_match"], r
