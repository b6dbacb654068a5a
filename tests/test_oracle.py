"""Every registered query against its DuckDB oracle at sf0.01 (exact values)."""

import pytest
from conftest import SF_ORACLE

from logonlens.plans.oracle_sql import ORACLE
from logonlens.plans.queries import QUERIES
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, SF_ORACLE)
    assert result["ok"], result
