"""A hand-made star schema with the awkward cases: null region, null date, null amount, a tie, and
a sale of a customer nobody knows."""

import datetime as dt
from decimal import Decimal

from starfold.operators.star import build_reporting

FACT = (
    "TransactionID string, SaleDate date, CustomerID string, ProductID string, StoreID bigint, "
    "CampaignID string, SaleAmount decimal(18,2)"
)


def _sale(number, date, customer, product, amount):
    return (
        str(number),
        date and dt.date.fromisoformat(date),
        customer,
        product,
        1,
        "none",
        amount and Decimal(amount),
    )


SALES = [
    _sale(1, "2024-11-15", "C1", "P1", "100.00"),
    _sale(2, "2025-02-03", "C1", "P2", "250.50"),
    _sale(3, "2025-02-20", "C2", "P2", "250.50"),
    _sale(4, "2025-05-09", "C2", "P3", "40.25"),
    _sale(5, "2025-05-30", "C3", "P1", "9.99"),
    _sale(6, "2025-08-01", "C9", "P1", "500.00"),
    _sale(7, None, "C1", "P3", "5.00"),
    _sale(8, "2025-05-31", "C1", "P1", None),
]
CUSTOMERS = [("C1", "Ann", "East"), ("C2", "Bob", "West"), ("C3", "Cy", None)]
PRODUCTS = [("P1", "Pen", "Office"), ("P2", "TV", "Electronics"), ("P3", "Hat", "Clothing")]


def star(spark):
    return (
        spark.createDataFrame(SALES, FACT),
        spark.createDataFrame(CUSTOMERS, "CustomerID string, Name string, Region string"),
        spark.createDataFrame(PRODUCTS, "ProductID string, ProductName string, Category string"),
    )


def reporting(spark):
    return build_reporting(*star(spark))


def rows(df):
    return [tuple(r) for r in df.collect()]
