import dataclasses
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import starfold as sf
from sample import reporting as make_reporting
from plans import settings
from sample import rows, star
from starfold.functions import composite_label
from starfold.schema import REPORTING_COLUMNS


@pytest.fixture(scope="module")
def sales(spark):
    return make_reporting(spark).persist()


@pytest.fixture(scope="module", params=["detail", "cuboid"])
def either(request, sales):
    """The detail, and its base cuboid, on which every operator must give the same."""
    return sales if request.param == "detail" else sf.base_cuboid(sales)


def test_reporting_relation(sales):
    assert tuple(sales.columns) == REPORTING_COLUMNS
    ordered = sales.orderBy(F.asc_nulls_last("SaleDate"))
    assert [r.TransactionID for r in ordered.collect()] == ["1", "2", "3", "4", "5", "8", "7"]
    first = ordered.first()
    assert (first.SalesYear, first.SalesQuarter, first.YearMonth) == (2024, 4, "2024-11")
    assert (first.CustomerName, first.ProductName) == ("Ann", "Pen")


def test_slice(either):
    assert rows(sf.slice_by(either, "Region", "East")) == [
        ("East", "Electronics", 250.50),
        ("East", "Office", 100.00),
        ("East", "Clothing", 5.00),
    ]


def test_slice_of_unknown_region_member(either):
    assert rows(sf.slice_by(either, "Region", None)) == [(None, "Office", 9.99)]


def test_empty_slice_is_empty_and_can_be_required(either):
    empty = sf.slice_by(either, "Region", "North")
    assert rows(empty) == []
    with pytest.raises(ValueError, match="no sales in North"):
        sf.require_rows(empty, "no sales in North")
    assert sf.require_rows(either, "never") is either


def test_dice(either):
    cells = sf.dice_by(
        either, {"Region": ("East", "West"), "Category": ["Clothing", "Electronics"]}
    )
    assert rows(cells) == [
        ("East", "Electronics", 250.50),
        ("West", "Electronics", 250.50),
        ("West", "Clothing", 40.25),
        ("East", "Clothing", 5.00),
    ]


def test_dice_takes_any_number_of_members_and_dimensions(either):
    assert rows(
        sf.dice_by(either, {"Region": ["East", None], "Category": ["Office"], "SalesYear": [2025]})
    ) == [(None, "Office", 2025, 9.99), ("East", "Office", 2025, None)]
    with pytest.raises(ValueError, match="no members"):
        sf.dice_by(either, {"Region": []})
    with pytest.raises(ValueError, match="at least one"):
        sf.dice_by(either, {})


def test_labels(sales):
    cells = sf.dice_by(sales, {"Region": ["East", None], "Category": ["Office"]})
    shown = composite_label(["Region", "Category"]).alias("l")
    hidden = composite_label(["Region", "Category"], null_text=None).alias("l")
    assert rows(cells.select(shown)) == [("East / Office",), ("(null) / Office",)]
    assert rows(cells.select(hidden)) == [("East / Office",), ("Office",)]


ROLLUP = [
    ("Month", 2024, 4, "2024-11", 100.00),
    ("Quarter", 2024, 4, None, 100.00),
    ("Year", 2024, None, None, 100.00),
    ("Month", 2025, 1, "2025-02", 501.00),
    ("Quarter", 2025, 1, None, 501.00),
    ("Month", 2025, 2, "2025-05", 50.24),
    ("Quarter", 2025, 2, None, 50.24),
    ("Year", 2025, None, None, 551.24),
    ("Month", None, None, None, 5.00),
    ("Quarter", None, None, None, 5.00),
    ("Year", None, None, None, 5.00),
    ("All Years", None, None, None, 656.24),
]


def test_rollup_keeps_unknown_date_apart_from_grand_total(either):
    assert rows(sf.rollup_levels(either)) == ROLLUP


def test_rollup_of_nothing(sales):
    nothing = sales.filter("false")
    assert rows(sf.rollup_levels(nothing)) == []
    assert rows(sf.grand_total(nothing)) == [("All Years", None)]
    assert rows(sf.latest_member(nothing)) == [(None,)]
    with pytest.raises(ValueError, match="no period"):
        sf.latest_value(nothing)
    assert rows(sf.drill_levels(nothing)) == []
    assert rows(sf.top_bottom(nothing)) == []


def test_single_levels_agree_with_rollup(either):
    assert rows(sf.rollup_at(either)) == [(2024, 100.00), (2025, 551.24), (None, 5.00)]
    assert rows(sf.rollup_at(either, "Quarter")) == [
        (2024, 4, 100.00), (2025, 1, 501.00), (2025, 2, 50.24), (None, None, 5.00),
    ]
    assert rows(sf.grand_total(either)) == [("All Years", 656.24)]


def test_quarter_labels(either):
    trend = sf.with_period_label(sf.rollup_levels(either), "Quarter")
    assert [r.PeriodLabel for r in trend.collect()] == ["2024-Q4", "2025-Q1", "2025-Q2", None]


DRILL_2025 = [
    (1, "Year", "2025", None, None, 551.24),
    (2, "Quarter", "2025-Q1", 1, None, 501.00),
    (2, "Quarter", "2025-Q2", 2, None, 50.24),
    (3, "Month", "2025-02", 1, "2025-02", 501.00),
    (3, "Month", "2025-05", 2, "2025-05", 50.24),
]


@pytest.mark.parametrize("member", [2025, (2025,), None])
def test_drill_down(either, member):
    assert rows(sf.drill_levels(either, member)) == DRILL_2025


def test_drill_down_of_restricted_latest(either):
    assert rows(sf.drill_levels(sf.restrict_latest(either))) == DRILL_2025


def test_drill_down_path(either):
    assert rows(sf.drill_levels(either, (2025, 2))) == [
        (1, "Quarter", "2025-Q2", None, 50.24),
        (2, "Month", "2025-05", "2025-05", 50.24),
    ]
    with pytest.raises(ValueError, match="path"):
        sf.drill_levels(either, (2025, 2, "2025-05", 1))


def test_drill_down_of_absent_year(either):
    assert rows(sf.drill_levels(either, 1999)) == []
    assert rows(sf.drill_at(either, 1999)) == []


def test_drill_to_one_level(either):
    assert rows(sf.drill_at(either, 2025)) == [("2025-02", 501.00), ("2025-05", 50.24)]
    assert rows(sf.drill_at(either, 2025, "Quarter")) == [(1, 501.00), (2, 50.24)]
    assert rows(sf.level_rows(sf.drill_levels(either, 2025), "Month").select("YearMonth")) == [
        ("2025-02",), ("2025-05",),
    ]


def test_latest_and_strongest(either):
    assert sf.latest_value(either) == 2025
    assert sf.latest_value(either, "Month") == "2025-05"
    assert rows(sf.strongest_period(either)) == [("2025-02", 501.00)]
    assert rows(sf.strongest_period(either, 2024)) == [("2024-11", 100.00)]
    assert rows(sf.strongest(either, "SalesYear")) == [(2025, 551.24)]
    # A tie goes to the first key.
    assert rows(sf.strongest(either, ["Region", "Category"])) == [("East", "Electronics", 250.50)]


def test_operators_compose(either):
    east = sf.restrict(either, {"Region": "East", "SalesYear": 2025})
    assert rows(sf.rollup_at(east)) == [(2025, 250.50)]
    assert rows(sf.rollup_at(sf.restrict(either, {"SalesYear": [2024, None]}))) == [
        (2024, 100.00), (None, 5.00),
    ]


def test_top_bottom(either):
    assert rows(sf.top_bottom(either, n=2)) == [
        ("Top", 1, "East / Electronics", 250.50),
        ("Top", 2, "West / Electronics", 250.50),
        ("Bottom", 1, "East / Clothing", 5.00),
        ("Bottom", 2, "(null) / Office", 9.99),
    ]
    assert rows(sf.top_bottom(either, "Category", 2, ascending=True)) == [
        ("Top", 2, "Office", 109.99),
        ("Top", 1, "Electronics", 501.00),
        ("Bottom", 1, "Clothing", 45.25),
        ("Bottom", 2, "Office", 109.99),
    ]


def test_top_bottom_caps_at_number_of_groups_and_counts_missing_as_zero(sales):
    only_missing = sales.filter("TransactionID in ('7', '8')")
    assert rows(sf.top_bottom(only_missing, "Category")) == [
        ("Top", 1, "Clothing", 5.00),
        ("Top", 2, "Office", 0.00),
        ("Bottom", 1, "Office", 0.00),
        ("Bottom", 2, "Clothing", 5.00),
    ]
    assert rows(sf.top_bottom(sales, n=0)) == []
    with pytest.raises(ValueError):
        sf.top_bottom(sales, n=-1)


def test_findings(either):
    found = sf.headline_findings(
        either,
        ("Region", "East"),
        {"Region": ["East", "West"], "Category": ["Clothing", "Electronics"]},
    )
    assert rows(found) == [
        (1, "slice", "Electronics", 250.50, "Electronics ($250.50)"),
        (2, "dice", "East / Electronics", 250.50, "East / Electronics ($250.50)"),
        (3, "rollup_total", "All Years", 656.24, "All Years ($656.24)"),
        (4, "rollup_year", "2025", 551.24, "2025 ($551.24)"),
        (5, "drilldown_month", "2025-02", 501.00, "2025-02 ($501.00)"),
    ]
    of_2024 = sf.headline_findings(either, ("Region", "East"), {"Region": ["West"]}, 2024)
    assert rows(of_2024.filter("FindingNo = 5"))[0][2] == "2024-11"


def test_findings_format_thousands(sales):
    big = sales.withColumn("SaleAmount", (F.col("SaleAmount") * 10000).cast("decimal(18,2)"))
    found = sf.headline_findings(big, ("Region", "East"), {"Region": ["East"]})
    assert rows(found)[0][4] == "Electronics ($2,505,000.00)"


def test_compare_and_average(either):
    assert rows(sf.compare_members(either, "Region", ("East", "West"), "Category")) == [
        ("Clothing", 5.00, 40.25, -35.25),
        ("Electronics", 250.50, 250.50, 0.00),
        ("Office", 100.00, None, 100.00),
    ]
    assert rows(sf.against_average(either, "Region")) == [
        ("East", 355.50, 218.75, 136.75),
        ("West", 290.75, 218.75, 72.00),
        (None, 9.99, 218.75, -208.76),
    ]


def test_trend(either):
    assert rows(sf.trend_by(either, "Region", "Year")) == [
        ("East", 2024, 100.00), ("East", 2025, 250.50), ("East", None, 5.00),
        ("West", 2025, 290.75), (None, 2025, 9.99),
    ]


def test_cube_tells_null_member_from_subtotal(either):
    got = rows(sf.cube_by(either, ["Region"]))
    assert got == [("East", 0, 355.50), ("West", 0, 290.75), (None, 0, 9.99), (None, 1, 656.24)]


def test_float_measures_of_any_size(spark):
    small = spark.range(1_000_000).selectExpr("'East' AS Region", "'A' AS Category", "1e-9D AS SaleAmount")
    six = dataclasses.replace(sf.SALES, scale=6)
    assert rows(sf.slice_by(small, "Region", "East", spec=six)) == [("East", "A", 0.001)]
    data = [("East", "A", 1e21), ("East", "A", 1.0)]
    large = spark.createDataFrame(data, "Region string, Category string, SaleAmount double")
    assert rows(sf.slice_by(large, "Region", "East")) == [("East", "A", 1e21)]
    narrow = dataclasses.replace(sf.SALES, float_as="decimal(28,8)")
    for ansi in ("true", "false"):
        with settings(spark, spark__sql__ansi__enabled=ansi):
            with pytest.raises(Exception, match="does not fit"):
                sf.slice_by(large, "Region", "East", spec=narrow).collect()


def _finding(df, number, **kwargs):
    found = sf.headline_findings(df, ("Region", "East"), {"Region": ["East"], "Category": ["A", "B", "C"]}, **kwargs)
    return next((r for r in found.collect() if r.FindingNo == number), None)


def test_findings_are_the_first_rows_of_the_operators(spark):
    """Ties after rounding, an unknown member, and whole-number keys that sort by value."""
    kind = "Region string, Category string, SalesYear int, SalesQuarter int, YearMonth string, SaleAmount decimal(18,3)"
    data = [
        ("East", "B", 2025, 1, "2025-01", Decimal("10.004")), ("East", "A", 2025, 1, "2025-02", Decimal("10.001")),
        ("East", None, 2024, 1, "2024-01", Decimal("10.003")),
    ]
    df = spark.createDataFrame(data, kind)
    assert _finding(df, 1).Member == sf.slice_by(df, "Region", "East").first().Category == "A"
    assert _finding(df, 2).Member == "East / A"
    assert _finding(df, 5).Member == sf.strongest_period(df).first().YearMonth == "2025-01"
    nulls = spark.createDataFrame([(r[0], c, *r[2:5], Decimal(5)) for r, c in zip(data, ("A", None, None))], kind)
    nulls = nulls.filter("YearMonth <> '2024-01'")
    assert _finding(nulls, 1).Member == sf.slice_by(nulls, "Region", "East").first().Category == "A"
    years = spark.createDataFrame([("East", "A", y, 1, "m", Decimal(1)) for y in (10, 9)], kind)
    assert _finding(years, 4).Member == str(sf.strongest(years, "SalesYear").first().SalesYear) == "9"


def test_findings_of_nothing_have_the_total(spark):
    empty = make_reporting(spark).filter("false")
    found = sf.headline_findings(empty, ("Region", "East"), {"Region": ["East"]}).collect()
    assert [(r.FindingNo, r.Member, r.TotalSales) for r in found] == [(3, "All Years", None)]
    assert rows(sf.grand_total(empty)) == [("All Years", None)]


def test_float_measure_is_summed_exactly_and_nan_is_missing(spark):
    data = [("East", "A", 0.1)] * 10 + [("East", "A", float("nan")), ("East", "B", 1.005)]
    df = spark.createDataFrame(data, "Region string, Category string, SaleAmount double")
    assert rows(sf.slice_by(df, "Region", "East")) == [("East", "B", 1.01), ("East", "A", 1.0)]


def test_totals_beyond_the_digits_of_a_double(spark):
    spec = dataclasses.replace(sf.SALES, total_type="decimal(38,2)")
    amounts = [Decimal("9007199254740993.01"), Decimal("9007199254740993.02")]
    df = spark.createDataFrame(
        [("East", "A", 2025, 1, "2025-01", a) for a in amounts],
        "Region string, Category string, SalesYear int, SalesQuarter int, YearMonth string, "
        "SaleAmount decimal(18,2)",
    )
    total = Decimal("18014398509481986.03")
    assert rows(sf.slice_by(df, "Region", "East", spec=spec)) == [("East", "A", total)]
    assert {r.TotalSales for r in sf.rollup_levels(df, spec).collect()} == {total}
    assert {r.TotalSales for r in sf.drill_levels(df, None, spec).collect()} == {total}
    assert {r.TotalSales for r in sf.top_bottom(df, spec=spec).collect()} == {total}
    assert sf.compare_members(df, "Region", ("East", "West"), "Category", spec).first().East == total
    found = sf.headline_findings(df, ("Region", "East"), {"Region": ["East"]}, spec=spec).first()
    assert (found.TotalSales, found.Text) == (total, "A ($18,014,398,509,481,986.03)")


def test_other_cubes(spark):
    spec = sf.CubeSpec(
        measure="qty", total="units", dimensions=("site",), all_name="World",
        levels=(sf.Level("country", "Country", "{country}"), sf.Level("city", "City", "{city}, {country}")),
    )
    df = spark.createDataFrame(
        [("s1", "FR", "Paris", 3), ("s2", "FR", "Lyon", 4), ("s1", "IT", "Rome", 5)],
        "site string, country string, city string, qty int",
    )
    assert rows(sf.rollup_levels(df, spec)) == [
        ("City", "FR", "Lyon", 4.0), ("City", "FR", "Paris", 3.0), ("Country", "FR", None, 7.0),
        ("City", "IT", "Rome", 5.0), ("Country", "IT", None, 5.0), ("World", None, None, 12.0),
    ]
    assert rows(sf.drill_levels(df, "FR", spec)) == [
        (1, "Country", "FR", None, 7.0), (2, "City", "Lyon, FR", "Lyon", 4.0),
        (2, "City", "Paris, FR", "Paris", 3.0),
    ]
    with pytest.raises(ValueError, match="unknown level"):
        sf.rollup_at(df, "Planet", spec)


def test_sql_view_with_bound_parameters(spark, sales):
    sf.register_view(sales, "sales_reporting")
    text = "SELECT count(*) FROM sales_reporting WHERE Region = ? AND Category IN (?, ?)"
    assert spark.sql(text, args=["East", "Office", "Clothing"]).first()[0] == 3


def test_checks(spark):
    fact, customers, products = star(spark)
    found = sf.orphan_facts(fact, {"CustomerID": customers, "ProductID": products})
    assert rows(found) == [("CustomerID", 1, 1), ("ProductID", 0, 0)]
    orphans = sf.orphan_rows(fact, customers, "CustomerID")
    assert [r.TransactionID for r in orphans.collect()] == ["6"]
    assert rows(sf.duplicate_keys(customers, "CustomerID")) == []
    assert rows(sf.duplicate_keys(customers.union(customers.limit(1)), "CustomerID")) == [("C1", 2)]
    assert rows(sf.row_count(fact)) == [(8,)]
    counted, observation = sf.observed_rows(fact)
    counted.collect()
    assert observation.get == {"rows": 8}
    with pytest.raises(ValueError, match="missing columns: Nope"):
        sf.require_columns(fact, ["Nope", "SaleDate"])
