"""Every registered query equals its DuckDB oracle SQL (order-insensitive)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert info["ok"], info


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    first = df.schema
    assert df.count() > 0
    assert entry.entry(spark).schema == first
    assert set(df.columns) == {"customer_category", "product_category", "sales_total",
                               "discount_total"}
