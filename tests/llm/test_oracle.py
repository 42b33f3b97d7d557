"""Queries with a SQL twin, row by row against DuckDB."""

import pytest

from devtrail.llm.queries import ORACLE, QUERIES
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, sf):
    sf_dir = f"/root/testdata/{sf}"
    r = compare(spark, duck(sf_dir), name, sf_dir, QUERIES, ORACLE)
    assert r["cols_match"] and r["rows_match"], r
