"""Explicit schemas. Inference is never used: it would read ``2025-05`` as a timestamp."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Required tables of the warehouse and the columns read from each.
WAREHOUSE_TABLES: dict[str, tuple[str, ...]] = {
    "fact_sales": (
        "TransactionID", "SaleDate", "CustomerID", "ProductID", "StoreID", "CampaignID", "SaleAmount",
    ),
    "dim_customers": ("CustomerID", "Name", "Region"),
    "dim_products": ("ProductID", "ProductName", "Category"),
}

# Columns of the reporting relation, in order.
REPORTING_COLUMNS: tuple[str, ...] = (
    "TransactionID", "SaleDate", "SalesYear", "SalesQuarter", "YearMonth",
    "CustomerID", "CustomerName", "Region",
    "ProductID", "ProductName", "Category",
    "StoreID", "CampaignID", "SaleAmount",
)

# Order of rows inside the files of the mart: what slices ask for, then other columns
# of few values, whose runs pack well in the files and in shuffles of what is read from them.
MART_CLUSTER: tuple[str, ...] = ("Region", "Category", "ProductName", "CampaignID")


def reporting_schema(
    *,
    sale_date: T.DataType = T.DateType(),
    keys: T.DataType = T.LongType(),
    store: T.DataType = T.LongType(),
) -> T.StructType:
    """Read schema of the exported reporting relation; the key types follow the warehouse."""
    types: dict[str, T.DataType] = {
        "SaleDate": sale_date,
        "SalesYear": T.IntegerType(),
        "SalesQuarter": T.IntegerType(),
        "CustomerID": keys,
        "ProductID": keys,
        "StoreID": store,
        "SaleAmount": MONEY,
    }
    return T.StructType(
        [T.StructField(name, types.get(name, T.StringType())) for name in REPORTING_COLUMNS]
    )


def schema_of(df) -> T.StructType:
    """Schema of an existing relation with every column nullable, as a text source returns it."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
