"""What the way from the tables to the mart and the extract shuffles and writes."""

import glob

import pytest

import sample
import starfold as sf
from plans import count, planned, settings
from starfold.operators.star import period_columns
from starfold.plans import report, retail
from starfold.schema import MART_CLUSTER, schema_of
from starfold.sources import extract, mart

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
COLUMNS = "SaleDate timestamp_ntz, TransactionID string, SalesYear int, SalesQuarter int, YearMonth string, v string"


def _sales(spark):
    """Dates that are null, the same key twice, and rows that are the same in every column."""
    dated = spark.sql(
        "SELECT IF(id % 7 = 0, NULL, TIMESTAMP_NTZ'2023-12-30 23:59:59.000001' + MAKE_DT_INTERVAL(CAST(id % 5 AS INT)))"
        " AS SaleDate, IF(id % 11 = 0, NULL, CAST(id % 4 AS STRING)) AS TransactionID, IF(id % 3 = 0, NULL, 'v') AS v"
        " FROM range(200)"
    )
    return dated.withColumns(period_columns()).selectExpr(*[c.split()[0] for c in COLUMNS.split(", ")])


def _below_the_shuffle(frame, kind):
    return planned(frame).split(f"Exchange {kind}")[1].split("\n", 1)[1]


def test_the_extract_shuffles_neither_its_hash_nor_what_follows_from_the_date(spark, tmp_path):
    stored = str(tmp_path / "stored")
    _sales(spark).write.parquet(stored)
    sales = spark.read.parquet(stored)
    below = _below_the_shuffle(extract._ordered(sales, ["SaleDate", "TransactionID"], period_columns()), "rangepartitioning")
    assert "SaleDate" in below and "__source" in below
    assert not count(below, "SalesYear|SalesQuarter|YearMonth|__tie|xxhash64")


@pytest.mark.parametrize("derived", [None, period_columns, lambda: {**period_columns(), "TransactionID": None}])
def test_the_extract_keeps_rows_order_and_columns(spark, tmp_path, derived):
    sales = _sales(spark)
    path = sf.export_csv(sales, str(tmp_path / "csv"), derived=derived and derived())
    lines = []
    for part in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(part) as f:
            header, *body = f.read().splitlines()
        assert header == ",".join(sales.columns)
        lines += [line.split(",") for line in body]
    keys = [(not line[0], line[0], not line[1], line[1]) for line in lines]
    assert keys == sorted(keys) and len(keys) == 200
    back = sf.read_reporting_csv(spark, path, schema_of(sales))
    assert sorted(map(str, back.collect())) == sorted(map(str, sales.collect()))


def test_wide_rows_cross_no_shuffle_before_the_mart(spark, tmp_path):
    """Lines are shuffled to their products and orders; what is made of them afterwards is not."""
    folder = "/root/testdata/sf0.001"
    plain = retail.reporting(spark, folder)
    with settings(spark, **NO_BROADCAST):
        sales = retail.reporting(spark, folder, whole=True)
        plan = planned(mart._clustered(sales, "SalesYear", MART_CLUSTER, rebalance=False))
        assert "REBALANCE" not in plan
        # Read from the top: the texts are made above every shuffle, and lines meet the products first.
        assert max(plan.index("concat_ws"), plan.index("date_format")) < plan.index("Exchange")
        assert plan.index("SortMergeJoin [o_orderkey") < plan.index("SortMergeJoin [ProductID")
        assert "REBALANCE" in planned(mart._clustered(sales, "SalesYear", MART_CLUSTER, rebalance=True))
    path = sf.write_mart(sales, str(tmp_path / "mart"), cluster=MART_CLUSTER, rebalance=False)
    found = sf.read_mart(spark, path, schema_of(sales))
    assert found.columns == plain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


def test_a_report_writes_its_mart_from_the_join(spark, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr(report, "write_mart", lambda df, path, **how: seen.update({path: how}) or mart.write_mart(df, path, **how))
    for name, df in zip(("fact_sales", "dim_customers", "dim_products"), sample.star(spark)):
        df.write.parquet(str(tmp_path / "in" / name))
    report.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert seen[f"{tmp_path}/out/mart"]["rebalance"] is False
    assert "rebalance" not in seen[f"{tmp_path}/out/cuboid"]
