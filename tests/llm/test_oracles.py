"""The registered queries that SQL can express, against that SQL."""

import pytest

import oracle
from starfold.llm.queries import oracle_sql, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows_as_sql(spark, name):
    expected = oracle.sql_rows(oracle.connect(FOLDER), oracle_sql()[name])
    assert oracle.spark_rows(queries()[name](spark, FOLDER)) == expected
