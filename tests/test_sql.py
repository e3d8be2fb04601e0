"""Table functions give the rows of the DataFrame operators."""

from dataclasses import replace

import pytest

import starfold as sf
from sample import reporting, rows
from starfold.plans.sql import register_functions


@pytest.fixture(scope="module")
def sales(spark):
    made = register_functions(spark, reporting(spark), "shop")
    assert made == ["shop_slice_region", "shop_slice_category", "shop_dice", "shop_rollup", "shop_drilldown"]
    return reporting(spark)


def same(got, want):
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(want)))


def test_slices(spark, sales):
    same(spark.sql("SELECT * FROM shop_slice_region(member => 'East')"), sf.slice_by(sales, "Region", "East"))
    same(spark.sql("SELECT * FROM shop_slice_region(NULL)"), sf.slice_by(sales, "Region", None))
    same(spark.sql("SELECT * FROM shop_slice_category('Office')"), sf.slice_by(sales, "Category", "Office"))
    same(spark.sql("SELECT * FROM shop_slice_region(member => :m)", args={"m": "it's"}), sf.slice_by(sales, "Region", "it's"))


def test_dices(spark, sales):
    same(
        spark.sql("SELECT * FROM shop_dice(of_region => ARRAY('East', 'West'), of_category => ARRAY('Office'))"),
        sf.dice_by(sales, {"Region": ["East", "West"], "Category": ["Office"]}),
    )
    same(
        spark.sql("SELECT * FROM shop_dice(of_category => ARRAY('Office')) WHERE Region IS NOT NULL"),
        sf.dice_by(sales, {"Region": ["East", "West"], "Category": ["Office"]}),
    )


def test_levels(spark, sales):
    same(spark.sql("SELECT * FROM shop_rollup()"), sf.rollup_levels(sales))
    same(spark.sql("SELECT * FROM shop_drilldown(member => 2024)"), sf.drill_levels(sales, 2024))
    same(spark.sql("SELECT * FROM shop_drilldown()"), sf.drill_levels(sales))
    assert spark.sql("SELECT * FROM shop_drilldown(1900)").count() == 0


def test_floating_measures_are_refused(spark, sales):
    with pytest.raises(TypeError, match="floating"):
        register_functions(spark, sales.withColumn("SaleAmount", sales.SaleAmount.cast("double")), "loose", replace(sf.SALES))


def test_a_member_reaches_the_scan(spark, sales, tmp_path):
    sf.write_mart(sales, f"{tmp_path}/mart")
    register_functions(spark, spark.read.parquet(f"{tmp_path}/mart"), "stored")
    plan = spark.sql("SELECT * FROM stored_drilldown(member => 2025)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SalesYear" in plan and "= 2025" in plan
