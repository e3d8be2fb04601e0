import glob

import pytest

import starfold as sf
from sample import rows, star
from starfold.__main__ import main
from starfold.plans.report import Questions, answers, run, write_answers


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    for name, df in zip(("fact_sales", "dim_customers", "dim_products"), star(spark)):
        df.write.parquet(str(folder / name))
    return str(folder)


def test_report_from_warehouse_to_answers(spark, warehouse, tmp_path):
    results, count = run(spark, warehouse, str(tmp_path))
    assert count == 7
    assert rows(results["findings"])[0] == (
        1, "slice", "Electronics", 250.50, "Electronics ($250.50)",
    )
    assert rows(results["quarterly_trend"].select("PeriodLabel", "TotalSales")) == [
        ("2024-Q4", 100.00), ("2025-Q1", 501.00), ("2025-Q2", 50.24), (None, 5.00),
    ]
    assert rows(results["dice"])[0] == ("East", "Electronics", 250.50, "East / Electronics")
    assert len(glob.glob(f"{tmp_path}/sales_reporting_csv/part-*.csv")) >= 1
    # The same answers from the detail.
    detail = answers(sf.read_mart(spark, f"{tmp_path}/mart"), Questions())
    for name, frame in results.items():
        assert rows(frame) == rows(detail[name]), name
    # The view serves SQL text.
    assert spark.sql("SELECT count(*) FROM sales_reporting").first()[0] == 7


@pytest.mark.parametrize(
    "ask, what",
    [
        (Questions(("Region", "North")), "slice"),
        (Questions(dice_on={"Region": ["East"], "Category": ["Toys"]}), "dice"),
        (Questions(member=1999), "drill-down"),
    ],
)
def test_empty_selections_raise(spark, warehouse, tmp_path, ask, what):
    with pytest.raises(ValueError, match=f"the {what} selects no rows"):
        run(spark, warehouse, str(tmp_path), ask)


def test_command_line(spark, warehouse, tmp_path, capsys):
    main([warehouse, str(tmp_path), "--region", "West", "--year", "2025", "--top", "2"])
    shown = capsys.readouterr().out
    assert "7 reporting rows" in shown
    assert f"findings: {tmp_path}/answers/findings" in shown
    found = spark.read.option("header", True).csv(f"{tmp_path}/answers/findings")
    assert "2025-02 ($501.00)" in {r.Text for r in found.collect()}


def test_answers_are_written_in_full(spark, tmp_path):
    long = spark.range(250).orderBy("id")
    paths = write_answers({"long": long}, str(tmp_path))
    assert spark.read.option("header", True).csv(paths["long"]).count() == 250
