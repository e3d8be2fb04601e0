"""From a star schema to one wide reporting relation.

The joins carry no hints. Spark broadcasts a dimension only while its size stays under
``spark.sql.autoBroadcastJoinThreshold``, judged by statistics when planning and by real shuffle
sizes at run time; past that it sort-merges, and adaptive execution splits partitions that one hot
key makes too large. Nothing here depends on a dimension staying small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions import quarter_of, year_month, year_of
from starfold.schema import REPORTING_COLUMNS


def attach_dimension(
    fact: DataFrame, dimension: DataFrame, key: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join a dimension on its key. Inner, so rows with an unknown key are left out;
    :func:`starfold.operators.checks.orphan_rows` shows them."""
    return fact.join(dimension, [key] if isinstance(key, str) else list(key), how)


def period_columns(date: str = "SaleDate") -> dict[str, Column]:
    """Year, quarter and ``YYYY-MM`` of the sale date, by name: a shuffle need not carry them."""
    return {
        "SalesYear": year_of(F.col(date)),
        "SalesQuarter": quarter_of(F.col(date)),
        "YearMonth": year_month(F.col(date)),
    }


def add_periods(df: DataFrame, date: str = "SaleDate") -> DataFrame:
    """Year, quarter and ``YYYY-MM`` of the sale date."""
    return df.withColumns(period_columns(date))


def customer_columns(customers: DataFrame) -> DataFrame:
    return customers.select("CustomerID", F.col("Name").alias("CustomerName"), "Region")


def product_columns(products: DataFrame) -> DataFrame:
    return products.select("ProductID", "ProductName", "Category")


def build_reporting(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The 14-column reporting relation; a query, not a copy."""
    joined = attach_dimension(fact, customer_columns(customers), "CustomerID")
    joined = attach_dimension(joined, product_columns(products), "ProductID")
    return add_periods(joined).select(*REPORTING_COLUMNS)


def register_view(reporting: DataFrame, name: str = "sales_reporting") -> DataFrame:
    """Create or replace a view, so that SQL text with bound parameters works as well."""
    reporting.createOrReplaceTempView(name)
    return reporting
