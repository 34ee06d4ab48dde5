"""Every registered query against its DuckDB oracle on the smallest tables,
and the flagship entry point."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMOKE
from oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_library_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMOKE)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["sku", "rank", "score", "match_count", "mask", "digits", "matched"]
    assert len(rows) == 10 and [r["rank"] for r in rows] == list(range(1, 11))
