"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from oracle_compare import compare, duck

from hydrix import bindings

NAMES = sorted(bindings.QUERIES)


def test_every_query_has_an_oracle():
    assert set(bindings.oracle_sql()) == set(bindings.QUERIES)
    assert set(bindings.QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    assert compare(df, con, E.oracle_sql()[name]) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["commune", "total_tests", "nb_conformes", "nb_non_conformes", "taux_conformite"]
    assert df.count() == 15
    assert SF_SMALL in E.SMOKE_DIR
