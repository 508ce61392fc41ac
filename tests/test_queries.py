"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connection, differences

# columns, methods or the size of a grid follow the values present; these need tables that have all of them
DATA_SHAPED = {"master_features", "encode_auto", "scale_auto", "scale_quantile_normal"}
FULL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - DATA_SHAPED))
def test_query_equals_sql(spark, small, con, name):
    assert differences(entry.queries()[name](spark, small), con, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(DATA_SHAPED))
def test_data_shaped_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, FULL), connection(FULL), entry.oracle_sql()[name]) is None


def test_every_query_with_sql_is_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_one_row_per_cleaned_customer(spark):
    out = entry.entry(spark)
    assert out.count() == out.select("customer_id").distinct().count() > 0
