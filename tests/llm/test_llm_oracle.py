"""Every training-data query with SQL against DuckDB over the whole tables at sf0.01."""

import pytest

from conftest import SF_ORACLE
from oracle_compare import compare, duck

from hydrix.llm import queries


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF_ORACLE), con, queries.oracle_sql()[name]) == []
