import os

import pytest

import sample
import starfold as sf
from plans import count, planned, ran, settings
from starfold.plans import retail
from starfold.schema import schema_of
from starfold.sources import shared_folder

FOLDER = "/root/testdata/sf0.001"


def test_reports_on_stored_tables_shuffle_neither_lines_nor_headers(spark):
    plain = retail.reporting(spark, FOLDER)
    path = shared_folder(spark, "stored")
    stored = retail.stored_reporting(spark, FOLDER, path, "test_stored")
    assert stored.columns == plain.columns
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
    no_broadcast = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    with settings(spark, **no_broadcast):
        lines, headers = spark.table("test_stored_lines"), spark.table("test_stored_headers")
        total = lines.join(headers, "o_orderkey").groupBy("Region").sum("SaleAmount")
        plan = ran(total)
        assert count(plan, "SortMergeJoin") == 1 and count(plan, "Exchange hashpartitioning") == 1
        before = plan.index("SortMergeJoin")
        assert "Exchange" not in plan[before:]
        assert sample.rows(sf.rollup_levels(stored)) == sample.rows(sf.rollup_levels(plain))
    files = [f for f in os.listdir(f"{path}/lines") if f.endswith(".parquet")]
    assert len(files) <= 8
    for name in ("test_stored_lines", "test_stored_headers"):
        spark.sql(f"DROP TABLE {name}")


def test_the_latest_year_is_read_from_folders(spark):
    sales = sample.reporting(spark)
    path = sf.write_mart(sales, shared_folder(spark, "mart"))
    latest = sf.latest_partition(spark, path)
    assert sample.rows(latest) == sample.rows(sf.latest_member(sales)) == [(2025,)]
    assert latest.dtypes == sf.latest_member(sales).dtypes
    assert "FileScan" not in planned(latest)
    mart = sf.read_mart(spark, path, schema_of(sales))
    only = mart.filter(mart["SalesYear"] == latest.scalar())
    assert sample.rows(sf.drill_levels(only)) == sample.rows(sf.drill_levels(sales))
    os.makedirs(f"{path}/SalesYear=2031")
    os.makedirs(f"{path}/SalesYear=later")
    assert sample.rows(sf.latest_partition(spark, path)) == [(2025,)]


@pytest.mark.parametrize("condition", ["false", "SalesYear IS NULL"])
def test_a_mart_without_years_has_no_latest(spark, condition):
    path = sf.write_mart(sample.reporting(spark).filter(condition), shared_folder(spark, "mart"))
    assert sample.rows(sf.latest_partition(spark, path)) == [(None,)]


def test_members_are_compared_as_their_type(spark):
    df = spark.createDataFrame([(1, "9/x"), (2, "10/x")], "v int, k string")
    path = sf.write_mart(df, shared_folder(spark, "mart"), "k")
    assert sample.rows(sf.latest_partition(spark, path, "k", "string")) == [("9/x",)]
    numbers = sf.write_mart(df.selectExpr("v", "v * 9 + 1 AS n"), shared_folder(spark, "mart"), "n")
    assert sample.rows(sf.latest_partition(spark, numbers, "n")) == [(19,)]
