"""Every registered query against independent SQL, on a folder of the given tables."""

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_registry_is_consistent():
    assert set(entry._oracle_sql()) == set(entry._queries())
    assert set(entry._queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry._oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    names, rows = oracle.spark_rows(entry.queries()[name](spark, FOLDER))
    expected_names, expected = oracle.sql_rows(con, entry.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["SummaryLevel", "SalesYear", "SalesQuarter", "YearMonth", "TotalSales"]
    assert df.count() > 0
