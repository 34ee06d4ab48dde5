"""The SQL of the llm queries on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMOKE
from likewise.llm.queries import ORACLE_SQL
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMOKE)
