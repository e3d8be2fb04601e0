"""The shape of the plans: what must hold when the data is a million times larger."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import starfold as sf
from plans import count, planned, ran, settings
from starfold.plans import retail
from starfold.plans.session import SETTINGS

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def sales(spark):
    return retail.reporting(spark, FOLDER)


@pytest.mark.parametrize("name", sorted(entry._queries()))
def test_no_python_no_cross_join_anywhere(spark, name):
    plan = planned(entry._queries()[name](spark, FOLDER))
    assert not count(plan, "Python|Pandas|Arrow|CartesianProduct|NestedLoop|CollectLimit"), plan


@pytest.mark.parametrize("operator", [sf.rollup_levels, sf.cube_by, lambda d: sf.drill_levels(d, 2000)])
def test_levels_expand_totals_not_facts(sales, operator):
    plan = planned(operator(sales))
    assert count(plan, r"Expand \[") == 1
    assert "Union" not in plan
    # Read from the top: the expansion comes after (above) the aggregation of the joined facts.
    assert plan.index("Expand [") < plan.index("partial_sum(SaleAmount")


def test_slice_reaches_the_scan_and_reads_needed_columns_only(sales):
    plan = planned(sf.slice_by(sales, "Region", "ASIA"))
    assert "EqualTo(r_name,ASIA)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert count(plan, "FileScan") == 6


def test_year_reaches_the_scan_as_a_range(sales):
    plan = planned(sf.drill_levels(sales, 2000))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01" in plan
    assert "LessThan(o_orderdate,2001-01-01" in plan
    plan = planned(sf.dice_by(sales, {"SalesYear": [1998, 2000]}))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01" in plan
    assert "LessThan(o_orderdate,2001-01-01" in plan
    # An unknown year has no date to look for.
    assert "GreaterThan" not in planned(sf.dice_by(sales, {"SalesYear": [1998, None]}))


def test_latest_year_of_a_mart_prunes_partitions(spark, sales, tmp_path):
    mart = sf.read_mart(spark, sf.write_mart(sales, str(tmp_path / "m")))
    plan = ran(sf.drill_at(sf.restrict_latest(mart)))
    assert count(plan, r"PartitionFilters: \[\(SalesYear#\d+ = Subquery") >= 1


def test_top_bottom_keeps_n_rows_per_task_and_aggregates_once(sales):
    plan = ran(sf.top_bottom(sales))
    assert count(plan, "TakeOrderedAndProject") == 2
    assert count(plan, "ReusedExchange") == 1
    assert count(plan, "FileScan") == 6


def test_strongest_is_a_top_k(sales):
    assert count(planned(sf.strongest(sales, "YearMonth")), "TakeOrderedAndProject") == 1


@pytest.mark.parametrize(
    "operator",
    [
        sf.drill_levels,
        sf.strongest_period,
        lambda d: sf.against_average(d, "Region"),
        lambda d: sf.headline_findings(d, ("Region", "ASIA"), {"Region": ["ASIA", "EUROPE"]}),
    ],
)
def test_facts_are_scanned_once(sales, operator):
    plan = ran(operator(sales))
    assert count(plan, "FileScan parquet.*lineitem") == 1


def test_orphans_are_counted_per_key_in_one_pass_before_the_join(spark):
    fact = retail.fact_sales(spark, FOLDER)
    dimensions = {
        "CustomerID": retail.dim_customers(spark, FOLDER), "ProductID": retail.dim_products(spark, FOLDER)
    }
    with settings(spark, **NO_BROADCAST):
        plan = planned(sf.orphan_facts(fact, dimensions))
    # Read from the top: the counts per key are below the join.
    assert plan.index("LeftAnti") < plan.rindex("partial_count(1)")
    assert count(plan, "FileScan parquet.*lineitem") == 1
    assert count(plan, "FileScan parquet.*orders") == 1


def test_null_keys_go_round_the_anti_join(spark):
    fact = spark.createDataFrame([(1, None), (2, 7), (3, 8)], "id int, k int")
    found = sf.orphan_rows(fact, spark.createDataFrame([(7,)], "k int"), "k")
    assert sorted(r.id for r in found.collect()) == [1, 3]
    assert "Union" in planned(found)


def test_quartiles_test_brackets_before_a_row_becomes_many(spark):
    values = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS a", "CAST(-id AS DOUBLE) AS b")
    plan = planned(sf.numeric_summary(values))
    # Read from the top: between the join with the brackets and the values there is a filter.
    assert "Filter" in plan[plan.rindex("BroadcastHashJoin") : plan.rindex("posexplode")]


def test_dimensions_of_any_size(spark):
    """Nothing is broadcast unless Spark knows it is small enough."""
    with settings(spark, **NO_BROADCAST):
        sales = retail.reporting(spark, FOLDER)
        plan = planned(sf.slice_by(sales, "Region", "ASIA"))
        assert count(plan, "SortMergeJoin") == 5
        assert count(plan, "Broadcast") == 0
        result = sf.slice_by(sales, "Region", "ASIA").collect()
    assert result == sf.slice_by(retail.reporting(spark, FOLDER), "Region", "ASIA").collect()


def _one_third_on_one_key(spark, rows=600_000):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return spark.range(0, rows, 1, 16).select(
        key.alias("CustomerID"),
        (F.col("id") % 11).alias("ProductID"),
        F.lit("x" * 40).alias("StoreID"),
        F.col("id").cast("string").alias("TransactionID"),
        F.lit(None).cast("string").alias("CampaignID"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 700 AS INT))").alias("SaleDate"),
        F.lit(1).cast("decimal(18,2)").alias("SaleAmount"),
    )


SMALL_SPLITS = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
}
HOT = 200_000 + sum(1 for i in range(600_000) if i % 3 and i % 5000 == 7)


def _hot_customer_reporting(spark):
    customers = spark.range(5000).selectExpr(
        "id CustomerID", "'n' Name", "IF(id = 7, 'hot', 'other') Region"
    )
    products = spark.range(11).selectExpr("id ProductID", "'p' ProductName", "'c' Category")
    return sf.build_reporting(_one_third_on_one_key(spark), customers, F.broadcast(products))


def test_hot_key_is_split_over_tasks(spark):
    with settings(spark, **NO_BROADCAST, **SMALL_SPLITS):
        totals = sf.slice_by(_hot_customer_reporting(spark), "Category", "c", "Region")
        plan = ran(totals)
        assert count(plan, r"SortMergeJoin\(skew=true\)") >= 1
        assert [(r.Region, r.TotalSales) for r in totals.collect()] == [
            ("other", float(600_000 - HOT)), ("hot", float(HOT)),
        ]


def test_hot_key_is_split_when_it_is_also_what_is_totalled(spark):
    """Grouping by the join key would otherwise stay in the one task that joins it."""
    forced = {k.replace(".", "__"): v for k, v in SETTINGS.items()}
    with settings(spark, **NO_BROADCAST, **SMALL_SPLITS, **forced):
        top = sf.strongest(_hot_customer_reporting(spark), "CustomerID")
        plan = ran(top)
        assert count(plan, r"SortMergeJoin\(skew=true\)") >= 1
        assert plan.index("Exchange hashpartitioning(CustomerID") > plan.index("HashAggregate(keys=[CustomerID")
        assert [tuple(r) for r in top.collect()] == [(7, float(HOT))]


def test_copies_of_one_row_are_merged_before_the_shuffle(spark):
    df = spark.range(0, 300_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("t")
    )
    assert [tuple(r) for r in sf.duplicate_rows(df).collect()] == [(300_000, 200_001, 99_999)]
    plan = planned(sf.duplicate_rows(df))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count(1)", plan.index("Exchange hash"))


def test_numeric_summary_scans_once_per_pass(spark):
    df = retail.table(spark, FOLDER, "lineitem").select("l_quantity", "l_tax")
    plan = ran(sf.numeric_summary(df))
    # The survey has run already; this is the only other pass.
    assert count(plan, "FileScan") == 1
    assert "percentile" not in plan


def test_mart_files_are_sized_by_rebalancing(spark, sales):
    hinted = sales.hint("rebalance", F.col("SalesYear"))
    assert "REBALANCE_PARTITIONS_BY_COL" in planned(hinted)
