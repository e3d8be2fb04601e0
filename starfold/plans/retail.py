"""The sales star schema on the ``lineitem``/``orders`` test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.star import (
    add_periods,
    attach_dimension,
    customer_columns,
    product_columns,
)
from starfold.schema import MONEY, REPORTING_COLUMNS, WAREHOUSE_TABLES
from starfold.sources.buckets import write_bucketed


# Column types of the test tables. With them a read needs no job to look at a footer.
TABLE_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def sale_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: what all its lines share."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("SaleDate"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderpriority").alias("CampaignID"),
    )


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        F.col("l_partkey").alias("ProductID"),
        F.col("l_suppkey").alias("StoreID"),
        F.col("l_extendedprice").cast(MONEY).alias("SaleAmount"),
    )


def _numbered(lines: DataFrame) -> DataFrame:
    """Lines with their number as one text, which is made after the joins: they carry its two parts."""
    return lines.withColumn("TransactionID", F.concat_ws("-", "o_orderkey", "l_linenumber"))


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    joined = attach_dimension(sale_lines(spark, folder), sale_headers(spark, folder), "o_orderkey")
    return _numbered(joined).select(*WAREHOUSE_TABLES["fact_sales"])


def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey")
    )
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation.join(region, "r_regionkey"), "c_nationkey")
        .select(
            F.col("c_custkey").alias("CustomerID"),
            F.col("c_name").alias("Name"),
            F.col("r_name").alias("Region"),
        )
    )


def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
    )


def reporting(spark: SparkSession, folder: str, whole: bool = False) -> DataFrame:
    """The reporting relation.

    Customers and calendar parts belong to the order, so they are attached to the headers, before
    the lines are joined: that shuffle then carries rows already cut to the wanted regions and
    dates, and a large customer dimension costs a shuffle of the orders only. How the headers meet
    the lines is for adaptive execution to decide, by the size that they turn out to have.

    ``whole``: for a reader of all rows and columns, such as a mart. Lines then get their product
    first, while they are narrow, and what the headers add is shuffled with no line. The rows are the same.
    """
    return _joined(
        sale_lines(spark, folder), _known_headers(spark, folder), dim_products(spark, folder), whole
    )


def _known_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer."""
    return attach_dimension(
        sale_headers(spark, folder), customer_columns(dim_customers(spark, folder)), "CustomerID"
    )


def _joined(
    lines: DataFrame, headers: DataFrame, products: DataFrame, products_first: bool = False
) -> DataFrame:
    steps = [(headers, "o_orderkey"), (product_columns(products), "ProductID")]
    for dimension, key in reversed(steps) if products_first else steps:
        lines = attach_dimension(lines, dimension, key)
    return add_periods(_numbered(lines)).select(*REPORTING_COLUMNS)


def stored_reporting(
    spark: SparkSession, folder: str, path: str, tables: str = "sales", buckets: int = 8
) -> DataFrame:
    """The reporting relation over lines and headers that are stored by order, as the catalog tables
    ``<tables>_lines`` and ``<tables>_headers``: reports on it do not shuffle the lines."""
    lines = write_bucketed(sale_lines(spark, folder), f"{tables}_lines", f"{path}/lines", "o_orderkey", buckets)
    headers = write_bucketed(
        _known_headers(spark, folder), f"{tables}_headers", f"{path}/headers", "o_orderkey", buckets
    )
    return _joined(lines, headers, dim_products(spark, folder))
