
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from importlib import import_module
from warnings import warn
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import starfold as sf
from starfold.functions import composite_label
from starfold.operators.star import period_columns
from starfold.plans import report, retail
from starfold.plans.session import prepare
from starfold.plans.sql import register_functions
from starfold.schema import MART_CLUSTER, schema_of
from starfold.sources import shared_folder

REGION = "ASIA"
REGIONS = ["ASIA", "EUROPE"]
CATEGORIES = ["SMALL", "LARGE"]
YEAR = 2000
_BEYOND_DOUBLES = 2**53 + 1


def entry(spark: SparkSession) -> DataFrame:
    """Roll-up of all sales through the time hierarchy."""
    return sf.rollup_levels(retail.reporting(spark, "/root/testdata/sf0.001"))


# -- queries that need more than one call --------------------------------------------------------


def _shown(reporting: DataFrame) -> DataFrame:
    """Amounts leave the decimal domain at the edge, as in every other result."""
    return reporting.withColumn("SaleAmount", F.col("SaleAmount").cast("double"))


def _mart_path(spark: SparkSession, folder: str) -> str:
    sales = retail.reporting(spark, folder, whole=True)
    return sf.write_mart(sales, shared_folder(spark, "sales_mart"), cluster=MART_CLUSTER, rebalance=False)


def _mart(spark: SparkSession, folder: str) -> DataFrame:
    return sf.read_mart(spark, _mart_path(spark, folder), schema_of(_view(spark, folder)))


def _csv(spark: SparkSession, folder: str) -> str:
    """The extract of the mart, so that the sort reads files and the star join runs once."""
    path = shared_folder(spark, "sales_reporting_csv")
    return sf.export_csv(_mart(spark, folder), path, derived=period_columns())


def _exported(spark: SparkSession, folder: str) -> DataFrame:
    schema = schema_of(_view(spark, folder))
    return sf.read_reporting_csv(spark, _csv(spark, folder), schema)


def _texts(name: str, order: list[str]):
    """A table with quotes and line breaks, written as CSV and read again."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        table = retail.table(spark, folder, name)
        path = sf.export_csv(table, shared_folder(spark, f"{name}_csv"), order, rows_per_file=100_000)
        return sf.read_reporting_csv(spark, path, table.schema)

    return run


def _warehouse(spark: SparkSession, folder: str) -> str:
    """The given tables as a warehouse of three."""
    path = shared_folder(spark, "warehouse")
    for name, frame in {
        "fact_sales": retail.fact_sales(spark, folder),
        "dim_customers": retail.dim_customers(spark, folder),
        "dim_products": retail.dim_products(spark, folder),
    }.items():
        # a dimension keeps the usual codec: the size of its files decides on a broadcast
        frame.write.parquet(f"{path}/{name}", compression="zstd" if name == "fact_sales" else None)
    return path


def _from_warehouse(spark: SparkSession, folder: str) -> DataFrame:
    tables = sf.open_warehouse(spark, _warehouse(spark, folder))
    reporting = sf.build_reporting(*(tables[n] for n in ("fact_sales", "dim_customers", "dim_products")))
    sf.require_rows(sf.restrict(reporting, {"Region": REGION}), f"no sales in {REGION}")
    return sf.slice_by(reporting, "Region", REGION)


def _report(answer: str):
    """One answer of a whole report: warehouse, mart, extract, cuboid, answers."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        ask = report.Questions(("Region", REGION), {"Region": REGIONS, "Category": CATEGORIES})
        results, _ = report.run(spark, _warehouse(spark, folder), shared_folder(spark, "report"), ask)
        return results[answer]

    return run


def _float_total(spark: SparkSession, folder: str) -> DataFrame:
    spec = replace(sf.SALES, measure="l_tax", total="TotalTax", scale=6)
    return sf.total_by(retail.table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], spec)


def _float_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Subtotals of a cuboid of a floating point measure, with no level given."""
    spec = replace(sf.SALES, measure="l_extendedprice", total="TotalPrice", date=None)
    lines = retail.table(spark, folder, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    return sf.cube_by(sf.base_cuboid(lines, [*keys, "l_suppkey"], spec), keys, spec)


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """The reporting relation over tables stored by order."""
    return retail.stored_reporting(spark, folder, shared_folder(spark, "stored"), f"sales_{uuid4().hex}")


def _typed_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of whole numbers beyond 2^53, of amounts and of doubles; amounts leave as text."""
    lines = retail.table(spark, folder, "lineitem").select(
        "l_partkey", "l_linenumber", "l_extendedprice",
        (F.col("l_orderkey") + _BEYOND_DOUBLES).alias("LargeKey"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Amount"),
    )
    return sf.typed_summary(lines).withColumn("Amount", F.col("Amount").cast("string"))


def _summary_mart(spark: SparkSession, folder: str) -> DataFrame:
    cuboid = sf.base_cuboid(_view(spark, folder))
    path = sf.write_mart(cuboid, shared_folder(spark, "sales_summary"))
    return sf.read_mart(spark, path, schema_of(cuboid))


def _delta_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The cuboid after a load, a batch booked by mistake, its correction and late days; the last
    delivery comes twice, and years that changed are compacted."""
    sales = _mart(spark, folder)
    late = F.coalesce(F.col("SaleDate") >= f"{YEAR}-12-01", F.lit(False))
    mart = sf.DeltaMart(spark, shared_folder(spark, "sales_deltas"))
    mart.commit("load", sales.filter(~late))
    mart.commit("mistake", sf.restrict(sales, {"Region": REGION, "SalesYear": YEAR}))
    mart.commit("correction", removed=sf.restrict(sales, {"Region": REGION, "SalesYear": YEAR}))
    for _ in range(2):
        mart.commit("late", sales.filter(late))
    mart.compact("compacted", sales)
    return mart.read(sales)


def _sorted_out(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents whose length fits one byte, and the others."""
    documents = retail.table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    path = sf.export_csv(documents, shared_folder(spark, "documents_csv"), ["doc_id"])
    return sf.sort_out_csv(spark, path, "doc_id bigint, lang string, source string, n_chars tinyint")


def _rejected(spark: SparkSession, folder: str) -> DataFrame:
    rejected = _sorted_out(spark, folder)[1].select("fields", F.explode("failed").alias("f"))
    return rejected.select(F.col("fields")["doc_id"].alias("doc_id"), "f.column", "f.value")


def _sql_view(spark: SparkSession, folder: str) -> DataFrame:
    view = f"sales_reporting_{uuid4().hex}"
    sf.register_view(_view(spark, folder), view)
    return spark.sql(
        f"""
        SELECT Region, Category, CAST(ROUND(SUM(SaleAmount), 2) AS DOUBLE) AS TotalSales
        FROM {view} WHERE Region = :region
        GROUP BY Region, Category ORDER BY TotalSales DESC, Category
        """,
        args={"region": REGION},
    )


def _by_sql(call: str):
    """A table function over the reporting view, called from SQL."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        name = f"sales_{uuid4().hex}"
        register_functions(spark, _view(spark, folder), name)
        return spark.sql(f"SELECT * FROM {name}_{call}")

    return run


def _catalog_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The three tables by name, as views of the catalog, checked before they are joined."""
    suffix = f"_{uuid4().hex}"
    frames = {
        "fact_sales": retail.fact_sales(spark, folder),
        "dim_customers": retail.dim_customers(spark, folder),
        "dim_products": retail.dim_products(spark, folder),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name + suffix)
    names = [name + suffix for name in frames]
    sf.require_tables(spark, names)
    return sf.slice_by(sf.build_reporting(*map(spark.table, names)), "Region", REGION)


def _documents_with_labels(spark: SparkSession, folder: str) -> DataFrame:
    documents = retail.table(spark, folder, "documents")
    return documents.join(retail.table(spark, folder, "labels"), "doc_id", "left")


def _duplicates(spark: SparkSession, folder: str) -> DataFrame:
    sources = {"lineitem": None, "documents": ["text", "lang"]}
    found = [
        sf.duplicate_rows(retail.table(spark, folder, n), subset).withColumn("source", F.lit(n))
        for n, subset in sources.items()
    ]
    return found[0].unionByName(found[1])


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    fact = sf.orphan_facts(
        retail.fact_sales(spark, folder),
        {
            "CustomerID": retail.dim_customers(spark, folder),
            "ProductID": retail.dim_products(spark, folder),
        },
    )
    documents = sf.orphan_facts(
        retail.table(spark, folder, "documents"), {"doc_id": retail.table(spark, folder, "labels")}
    )
    return fact.unionByName(documents)


def _view(spark: SparkSession, folder: str) -> DataFrame:
    """The reporting view of a folder."""
    return retail.reporting(spark, folder)


def _csv_structure(spark: SparkSession, folder: str) -> DataFrame:
    return sf.structure(sf.read_csv(spark, _csv(spark, folder)))


def _unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    documents = retail.table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return sf.orphan_rows(documents, retail.table(spark, folder, "labels"), "doc_id")


def _summary_findings(spark: SparkSession, folder: str) -> DataFrame:
    return sf.headline_findings(
        _summary_mart(spark, folder), ("Region", REGION), {"Region": REGIONS, "Category": CATEGORIES}
    )


def _on(query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(_view(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes a session and a data folder."""

    def prepared(query):
        return lambda spark, folder: query(prepare(spark), folder)

    own = {name: prepared(query) for name, query in _queries().items()}
    return own | {name: query for part in _parts() for name, query in part.queries().items()}


def _parts() -> list:
    """The training-data operators and their pipeline, where they are installed."""
    found = []
    for name in ("starfold.llm.queries", "corpus_pipeline"):
        try:
            found.append(import_module(name))
        except ImportError as missing:
            if getattr(missing, "name", None) not in (name, "starfold.llm"):
                warn(f"{name} is left out: {missing}", stacklevel=2)
    return found


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    dice = {"Region": REGIONS, "Category": CATEGORIES}
    return {
        # sources, sinks, checks
        "reporting_view": _on(_shown),
        "sales_view_sql": _sql_view,
        "sql_slice": _by_sql(f"slice_region(member => '{REGION}')"),
        "sql_dice": _by_sql(f"dice(of_region => ARRAY({_quoted(REGIONS)}), of_category => ARRAY({_quoted(CATEGORIES)}))"),
        "sql_rollup": _by_sql("rollup()"),
        "sql_drilldown": _by_sql(f"drilldown(member => {YEAR})"),
        "sql_drilldown_latest": _by_sql("drilldown()"),
        "catalog_slice": _catalog_slice,
        "row_count": _on(sf.row_count),
        "export_reporting": lambda spark, folder: _shown(_exported(spark, folder)),
        "csv_roundtrip": lambda spark, folder: sf.rollup_levels(_exported(spark, folder)),
        "mart_drilldown": lambda spark, folder: sf.drill_levels(_mart(spark, folder), YEAR),
        "mart_latest": lambda spark, folder: sf.drill_levels(
            sf.restrict_latest(_mart(spark, folder))
        ),
        "mart_latest_listed": lambda spark, folder: sf.latest_partition(spark, _mart_path(spark, folder)),
        "stored_slice": lambda spark, folder: sf.slice_by(_stored(spark, folder), "Region", REGION),
        "stored_rollup": lambda spark, folder: sf.rollup_levels(_stored(spark, folder)),
        "delta_mart_rollup": lambda spark, folder: sf.rollup_levels(_delta_mart(spark, folder)),
        "csv_accepted": lambda spark, folder: _sorted_out(spark, folder)[0],
        "csv_rejected": _rejected,
        "summary_mart_rollup": lambda spark, folder: sf.rollup_levels(_summary_mart(spark, folder)),
        "summary_mart_findings": _summary_findings,
        "csv_structure": _csv_structure,
        "csv_conversations": _texts("conversations", ["conv_id", "turn"]),
        "csv_pages": _texts("pages", ["page_id"]),
        "warehouse_slice": _from_warehouse,
        "report_findings": _report("findings"),
        "report_rollup": _report("rollup"),
        "float_total": _float_total,
        "float_cube": _float_cube,
        "orphan_facts": _orphans,
        "orphan_rows": _unlabelled,
        "duplicate_keys": lambda spark, folder: sf.duplicate_keys(
            retail.fact_sales(spark, folder), "TransactionID"
        ),
        # slice and dice
        "slice_region": _on(lambda df: sf.slice_by(df, "Region", REGION)),
        "slice_category": _on(lambda df: sf.slice_by(df, "Category", "PROMO")),
        "slice_year": _on(lambda df: sf.slice_by(df, "SalesYear", YEAR, ["Region", "Category"])),
        "dice_region_category": _on(lambda df: sf.dice_by(df, dice)),
        "dice_three_dimensions": _on(lambda df: sf.dice_by(
            df, {"Region": [*REGIONS, "AFRICA"], "Category": ["SMALL"], "SalesYear": [1999, YEAR]}
        )),
        "dice_labelled": _on(lambda df: sf.dice_by(df, dice).withColumn(
            "RegionCategory", composite_label(["Region", "Category"])
        )),
        # roll-up
        "rollup_time": _on(sf.rollup_levels),
        "rollup_yearly": _on(sf.rollup_at),
        "rollup_of_slice": _on(lambda df: sf.rollup_levels(sf.restrict(df, {"Region": REGION}))),
        "grand_total": _on(sf.grand_total),
        "quarterly_trend": _on(lambda df: sf.with_period_label(
            sf.rollup_levels(df), "Quarter"
        ).select("PeriodLabel", "SalesYear", "SalesQuarter", "TotalSales")),
        # drill-down
        "latest_year": _on(sf.latest_member),
        "drilldown_time": _on(lambda df: sf.drill_levels(df, YEAR)),
        "drilldown_latest": _on(sf.drill_levels),
        "drilldown_quarter": _on(lambda df: sf.drill_levels(df, (YEAR, 3))),
        "drilldown_monthly": _on(lambda df: sf.drill_at(df, YEAR)),
        "monthly_trend": _on(lambda df: sf.level_rows(sf.drill_levels(df, YEAR), "Month").select(
            "PeriodLabel", "TotalSales"
        )),
        # ranking and findings
        "strongest_month": _on(sf.strongest_period),
        "strongest_year": _on(lambda df: sf.strongest(df, "SalesYear")),
        "headline_findings": _on(lambda df: sf.headline_findings(df, ("Region", REGION), dice)),
        "top_bottom": _on(sf.top_bottom),
        "top_bottom_single_key": _on(lambda df: sf.top_bottom(df, "Category", 3)),
        "top_bottom_customers": _on(lambda df: sf.top_bottom(df, ["CustomerID", "CustomerName"], 10)),
        "top_bottom_in_year": _on(lambda df: sf.top_bottom(sf.restrict(df, {"SalesYear": YEAR}))),
        # profiling
        "profile_structure": lambda spark, folder: sf.structure(
            retail.table(spark, folder, "orders")
        ),
        "profile_preview": _on(lambda df: sf.row_count(sf.preview(df, 7))),
        "profile_missing": lambda spark, folder: sf.missing_values(
            _documents_with_labels(spark, folder)
        ),
        "profile_missing_total": lambda spark, folder: sf.total_missing(
            _documents_with_labels(spark, folder)
        ),
        "profile_duplicates": _duplicates,
        "profile_numeric": lambda spark, folder: sf.numeric_summary(
            retail.table(spark, folder, "lineitem")
        ),
        "profile_columns": lambda spark, folder: sf.column_profile(
            retail.table(spark, folder, "lineitem")
        ),
        "profile_typed": _typed_numbers,
        "profile_numeric_sketch": lambda spark, folder: sf.sketch_check(
            retail.table(spark, folder, "lineitem")
        ),
        # reports described in words only
        "compare_regions": _on(
            lambda df: sf.compare_members(df, "Region", ("ASIA", "EUROPE"), "Category")
        ),
        "region_by_period": _on(lambda df: sf.trend_by(df, "Region", "Month")),
        "region_vs_average": _on(lambda df: sf.against_average(df, "Region")),
        "cube_region_category": _on(sf.cube_by),
    }


# -- the same in SQL -----------------------------------------------------------------------------

_REPORTING = """
WITH fact AS (
    SELECT l_orderkey || '-' || l_linenumber AS TransactionID, o_orderdate AS SaleDate,
           o_custkey AS CustomerID, l_partkey AS ProductID, l_suppkey AS StoreID,
           o_orderpriority AS CampaignID, CAST(l_extendedprice AS DECIMAL(18,2)) AS SaleAmount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), r AS (
    SELECT TransactionID, SaleDate,
           YEAR(SaleDate)::INTEGER AS SalesYear, QUARTER(SaleDate)::INTEGER AS SalesQuarter,
           LEFT(SaleDate::DATE::VARCHAR, 7) AS YearMonth,
           CustomerID, c_name AS CustomerName, r_name AS Region,
           ProductID, p_name AS ProductName, p_type AS Category,
           StoreID, CampaignID, SaleAmount
    FROM fact
    JOIN customer ON CustomerID = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON ProductID = p_partkey
)
"""

_TOTAL = "CAST(ROUND(SUM(SaleAmount), 2) AS DOUBLE) AS TotalSales"

_ROLLUP = f"""
SELECT CASE GROUPING_ID(SalesYear, SalesQuarter, YearMonth)
           WHEN 0 THEN 'Month' WHEN 1 THEN 'Quarter' WHEN 3 THEN 'Year' ELSE 'All Years'
       END AS SummaryLevel,
       SalesYear, SalesQuarter, YearMonth, {_TOTAL}
FROM {{source}} GROUP BY ROLLUP (SalesYear, SalesQuarter, YearMonth)
"""

#: Levels of a drill-down by GROUPING_ID of year, quarter and month: number, name, label.
_DRILL = f"""
, g AS (
    SELECT GROUPING_ID(SalesYear, SalesQuarter, YearMonth) AS gid, SalesYear, SalesQuarter,
           YearMonth, {_TOTAL}
    FROM r WHERE SalesYear = {{year}}
    GROUP BY GROUPING SETS (
        (SalesYear, SalesQuarter, YearMonth), (SalesYear, SalesQuarter), (SalesYear)
    )
)
, level(gid, SortLevel, DetailLevel) AS (VALUES (0, 3, 'Month'), (1, 2, 'Quarter'), (3, 1, 'Year'))
SELECT SortLevel, DetailLevel, SalesQuarter, YearMonth, TotalSales,
       COALESCE(YearMonth, CONCAT_WS('-Q', SalesYear, SalesQuarter)) AS PeriodLabel
FROM g JOIN level USING (gid)
"""

_LATEST = "(SELECT MAX(SalesYear) FROM r)"


def _top_bottom(source: str, keys: str, label: str, n: int) -> str:
    return f"""
, t AS (SELECT {keys}, {label} AS Label, {_TOTAL} FROM {source} GROUP BY {keys})
, s AS (
    SELECT 'Top' AS Side, ROW_NUMBER() OVER (ORDER BY TotalSales DESC, {keys}) AS Rank,
           Label, TotalSales FROM t
    UNION ALL
    SELECT 'Bottom', ROW_NUMBER() OVER (ORDER BY TotalSales, {keys}), Label, TotalSales FROM t
)
SELECT Side, CAST(Rank AS INTEGER) AS Rank, Label, TotalSales FROM s WHERE Rank <= {n}
"""


_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
)


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _profile_sql(name: str) -> str:
    parts = []
    for i, part in enumerate(retail.TABLE_SCHEMAS[name].split(", "), start=1):
        c, kind = part.split(" ")
        number = kind in ("int", "bigint", "double")
        shown = kind != "string"
        parts.append(
            f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{kind}' AS type,
            COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS missing, {number} AS "numeric",
            {f"ROUND(AVG({c}), 2)" if number else "CAST(NULL AS DOUBLE)"} AS mean,
            {f"ROUND(STDDEV_SAMP({c}), 2)" if number else "CAST(NULL AS DOUBLE)"} AS std,
            CAST({f"MIN({c})" if shown else "NULL"} AS VARCHAR) AS min,
            CAST({f"MAX({c})" if shown else "NULL"} AS VARCHAR) AS max FROM {name}"""
        )
    return " UNION ALL ".join(parts)


def _typed_sql() -> str:
    columns = {
        "l_partkey": "l_partkey", "l_linenumber": "l_linenumber", "l_extendedprice": "l_extendedprice",
        "LargeKey": f"l_orderkey + {_BEYOND_DOUBLES}", "Amount": "CAST(l_extendedprice AS DECIMAL(18,2))",
    }
    call = {"min": "MIN({})", "max": "MAX({})"} | {
        f"p{p}": "QUANTILE_DISC({}, 0." + str(p) + ")" for p in (25, 50, 75)
    }
    def taken(name: str, found: str) -> str:
        return f'CAST({found} AS VARCHAR) AS "{name}"' if name == "Amount" else f'{found} AS "{name}"'
    return " UNION ALL ".join(
        f"SELECT '{s}' AS statistic, "
        + ", ".join(taken(name, f.format(value)) for name, value in columns.items()) + " FROM lineitem"
        for s, f in call.items()
    )


def _numeric_sql(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(v) AS "count", ROUND(AVG(v), 2) AS mean,
        ROUND(STDDEV_SAMP(v), 2) AS std, ROUND(MIN(v), 2) AS "min",
        ROUND(QUANTILE_CONT(v, 0.25), 2) AS p25, ROUND(QUANTILE_CONT(v, 0.5), 2) AS p50,
        ROUND(QUANTILE_CONT(v, 0.75), 2) AS p75, ROUND(MAX(v), 2) AS "max"
        FROM (SELECT CAST({c} AS DOUBLE) AS v FROM lineitem)"""
        for c in columns
    )


def _money_text(amount: str) -> str:
    return f"'$' || FORMAT('{{:,.2f}}', {amount})"


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | {k: v for part in _parts() for k, v in part.oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    in_dice = f"Region IN ({_quoted(REGIONS)}) AND Category IN ({_quoted(CATEGORIES)})"
    whole = """SELECT TransactionID, SaleDate, SalesYear, SalesQuarter, YearMonth, CustomerID,
        CustomerName, Region, ProductID, ProductName, Category, StoreID, CampaignID,
        CAST(SaleAmount AS DOUBLE) AS SaleAmount FROM r"""
    slice_region = f"""SELECT Region, Category, {_TOTAL} FROM r WHERE Region = '{REGION}'
        GROUP BY Region, Category"""
    labelled = """SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"""
    missing = " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing
        FROM ({labelled})"""
        for i, c in enumerate(
            ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"), start=1
        )
    )
    def structure(source: str, columns: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT {i} AS position, '{c.split()[0]}' AS "column", '{c.split()[1]}' AS "type",
            COUNT(*) AS rows FROM {source}"""
            for i, c in enumerate(columns.split(", "), start=1)
        )

    orphans = """
        SELECT '{key}' AS dimension_key, COUNT(DISTINCT f.{fk}) AS orphan_keys,
               COUNT(*) AS orphan_rows
        FROM {fact} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dk} = f.{fk})"""
    duplicates = """
        SELECT '{name}' AS source, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS distinct_rows,
               CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
        FROM (SELECT COUNT(*) AS n FROM {name} GROUP BY {keys})"""
    best = "ORDER BY TotalSales DESC NULLS LAST, {key} LIMIT 1"
    findings = (
        _REPORTING
        + f"""
        , f AS (
            (SELECT 1 AS FindingNo, 'slice' AS Finding, Category AS Member, {_TOTAL} FROM r
             WHERE Region = '{REGION}' GROUP BY Category {best.format(key='Category')})
            UNION ALL
            (SELECT 2, 'dice', Region || ' / ' || Category, {_TOTAL} FROM r WHERE {in_dice}
             GROUP BY Region, Category {best.format(key='Region, Category')})
            UNION ALL
            (SELECT 3, 'rollup_total', 'All Years', {_TOTAL} FROM r)
            UNION ALL
            (SELECT 4, 'rollup_year', CAST(SalesYear AS VARCHAR), {_TOTAL} FROM r
             GROUP BY SalesYear {best.format(key='SalesYear')})
            UNION ALL
            (SELECT 5, 'drilldown_month', YearMonth, {_TOTAL} FROM r WHERE SalesYear = {_LATEST}
             GROUP BY YearMonth {best.format(key='YearMonth')})
        )
        SELECT *, Member || ' (' || {_money_text('TotalSales')} || ')' AS Text FROM f"""
    )
    return {
        "reporting_view": _REPORTING + whole,
        "sales_view_sql": _REPORTING + slice_region,
        "sql_slice": _REPORTING + slice_region,
        "sql_dice": _REPORTING
        + f"SELECT Region, Category, {_TOTAL} FROM r WHERE {in_dice} GROUP BY Region, Category",
        "sql_rollup": _REPORTING + _ROLLUP.format(source="r"),
        "sql_drilldown": _REPORTING + _DRILL.format(year=YEAR),
        "sql_drilldown_latest": _REPORTING + _DRILL.format(year=_LATEST),
        "catalog_slice": _REPORTING + slice_region,
        "row_count": _REPORTING + "SELECT COUNT(*) AS rows FROM r",
        "export_reporting": _REPORTING + whole,
        "csv_roundtrip": _REPORTING + _ROLLUP.format(source="r"),
        "mart_drilldown": _REPORTING + _DRILL.format(year=YEAR),
        "mart_latest": _REPORTING + _DRILL.format(year=_LATEST),
        "delta_mart_rollup": _REPORTING + _ROLLUP.format(source="r"),
        "csv_accepted": "SELECT doc_id, lang, source, n_chars FROM documents WHERE n_chars BETWEEN -128 AND 127",
        "csv_rejected": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'n_chars' AS "column",
            CAST(n_chars AS VARCHAR) AS value FROM documents WHERE n_chars NOT BETWEEN -128 AND 127""",
        "summary_mart_rollup": _REPORTING + _ROLLUP.format(source="r"),
        "csv_conversations": "SELECT * FROM conversations",
        "csv_pages": "SELECT * FROM pages",
        "mart_latest_listed": _REPORTING + "SELECT MAX(SalesYear) AS LatestMember FROM r",
        "stored_slice": _REPORTING + slice_region,
        "stored_rollup": _REPORTING + _ROLLUP.format(source="r"),
        "warehouse_slice": _REPORTING + slice_region,
        "report_findings": findings,
        "report_rollup": _REPORTING + _ROLLUP.format(source="r"),
        "float_total": """SELECT l_returnflag, l_linestatus, ROUND(SUM(l_tax), 6) AS TotalTax
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
        "float_cube": """SELECT l_returnflag, l_linestatus,
            CAST(GROUPING_ID(l_returnflag, l_linestatus) AS INTEGER) AS GroupingId,
            CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS TotalPrice
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
        "orphan_facts": _REPORTING
        + orphans.format(key="CustomerID", fk="CustomerID", fact="fact", dim="customer", dk="c_custkey")
        + " UNION ALL "
        + orphans.format(key="ProductID", fk="ProductID", fact="fact", dim="part", dk="p_partkey")
        + " UNION ALL "
        + orphans.format(key="doc_id", fk="doc_id", fact="documents", dim="labels", dk="doc_id"),
        "summary_mart_findings": findings,
        "csv_structure": _REPORTING
        + structure(
            "r",
            "TransactionID string, SaleDate string, SalesYear bigint, SalesQuarter bigint, "
            "YearMonth string, CustomerID bigint, CustomerName string, Region string, "
            "ProductID bigint, ProductName string, Category string, StoreID bigint, "
            "CampaignID string, SaleAmount double",
        ),
        "orphan_rows": """SELECT doc_id, lang, source, n_chars FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "duplicate_keys": _REPORTING
        + "SELECT TransactionID, COUNT(*) AS rows FROM fact GROUP BY TransactionID HAVING COUNT(*) > 1",
        "slice_region": _REPORTING + slice_region,
        "slice_category": _REPORTING
        + f"SELECT Category, Region, {_TOTAL} FROM r WHERE Category = 'PROMO' GROUP BY ALL",
        "slice_year": _REPORTING
        + f"SELECT SalesYear, Region, Category, {_TOTAL} FROM r WHERE SalesYear = {YEAR} GROUP BY ALL",
        "dice_region_category": _REPORTING
        + f"SELECT Region, Category, {_TOTAL} FROM r WHERE {in_dice} GROUP BY Region, Category",
        "dice_three_dimensions": _REPORTING
        + f"""SELECT Region, Category, SalesYear, {_TOTAL} FROM r
        WHERE Region IN ({_quoted([*REGIONS, 'AFRICA'])}) AND Category IN ('SMALL')
          AND SalesYear IN (1999, {YEAR}) GROUP BY ALL""",
        "dice_labelled": _REPORTING
        + f"""SELECT Region, Category, Region || ' / ' || Category AS RegionCategory, {_TOTAL}
        FROM r WHERE {in_dice} GROUP BY Region, Category""",
        "rollup_time": _REPORTING + _ROLLUP.format(source="r"),
        "rollup_yearly": _REPORTING + f"SELECT SalesYear, {_TOTAL} FROM r GROUP BY SalesYear",
        "rollup_of_slice": _REPORTING
        + _ROLLUP.format(source=f"(SELECT * FROM r WHERE Region = '{REGION}')"),
        "grand_total": _REPORTING + f"SELECT 'All Years' AS SummaryLevel, {_TOTAL} FROM r",
        "quarterly_trend": _REPORTING
        + f"""SELECT SalesYear || '-Q' || SalesQuarter AS PeriodLabel, SalesYear, SalesQuarter,
        {_TOTAL} FROM r GROUP BY SalesYear, SalesQuarter""",
        "latest_year": _REPORTING + "SELECT MAX(SalesYear) AS LatestMember FROM r",
        "drilldown_time": _REPORTING + _DRILL.format(year=YEAR),
        "drilldown_latest": _REPORTING + _DRILL.format(year=_LATEST),
        "drilldown_quarter": _REPORTING
        + f"""
        SELECT IF(GROUPING(YearMonth) = 1, 1, 2) AS SortLevel,
               IF(GROUPING(YearMonth) = 1, 'Quarter', 'Month') AS DetailLevel, YearMonth,
               COALESCE(YearMonth, '{YEAR}-Q3') AS PeriodLabel, {_TOTAL}
        FROM r WHERE SalesYear = {YEAR} AND SalesQuarter = 3 GROUP BY ROLLUP (YearMonth)""",
        "drilldown_monthly": _REPORTING
        + f"SELECT YearMonth, {_TOTAL} FROM r WHERE SalesYear = {YEAR} GROUP BY YearMonth",
        "monthly_trend": _REPORTING
        + f"""SELECT YearMonth AS PeriodLabel, {_TOTAL} FROM r WHERE SalesYear = {YEAR}
        GROUP BY YearMonth""",
        "strongest_month": _REPORTING
        + f"""SELECT YearMonth, {_TOTAL} FROM r WHERE SalesYear = {_LATEST} GROUP BY YearMonth
        {best.format(key='YearMonth')}""",
        "strongest_year": _REPORTING
        + f"""SELECT SalesYear, {_TOTAL} FROM r GROUP BY SalesYear {best.format(key='SalesYear')}""",
        "headline_findings": findings,
        "top_bottom": _REPORTING + _top_bottom("r", "Region, Category", "Region || ' / ' || Category", 5),
        "top_bottom_single_key": _REPORTING + _top_bottom("r", "Category", "Category", 3),
        "top_bottom_customers": _REPORTING
        + _top_bottom("r", "CustomerID, CustomerName", "CustomerID || ' / ' || CustomerName", 10),
        "top_bottom_in_year": _REPORTING
        + _top_bottom(
            f"(SELECT * FROM r WHERE SalesYear = {YEAR})", "Region, Category",
            "Region || ' / ' || Category", 5,
        ),
        "profile_structure": structure(
            "orders",
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
            "o_orderdate timestamp_ntz, o_orderpriority string",
        ),
        "profile_preview": _REPORTING + "SELECT LEAST(COUNT(*), 7) AS rows FROM r",
        "profile_numeric_sketch": " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{q}' AS quantile, TRUE AS enclosed"""
            for c in _NUMBERS for q in ("p25", "p50", "p75")
        ),
        "profile_missing": f"SELECT * FROM ({missing}) WHERE missing > 0",
        "profile_missing_total": f"SELECT CAST(SUM(missing) AS BIGINT) AS missing FROM ({missing})",
        "profile_duplicates": duplicates.format(name="lineitem", keys="ALL").replace(
            "SELECT COUNT(*) AS n FROM lineitem GROUP BY ALL",
            "SELECT COLUMNS(*), COUNT(*) AS n FROM lineitem GROUP BY ALL",
        )
        + " UNION ALL "
        + duplicates.format(name="documents", keys="text, lang"),
        "profile_numeric": _numeric_sql(_NUMBERS),
        "profile_columns": _profile_sql("lineitem"),
        "profile_typed": _typed_sql(),
        "compare_regions": _REPORTING
        + """
        SELECT Category, CAST(a AS DOUBLE) AS "ASIA", CAST(e AS DOUBLE) AS "EUROPE",
               CAST(a - e AS DOUBLE) AS "Difference"
        FROM (
            SELECT Category, SUM(CASE WHEN Region = 'ASIA' THEN SaleAmount END) AS a,
                   SUM(CASE WHEN Region = 'EUROPE' THEN SaleAmount END) AS e
            FROM r GROUP BY Category
        )""",
        "region_by_period": _REPORTING
        + f"SELECT Region, SalesYear, SalesQuarter, YearMonth, {_TOTAL} FROM r GROUP BY ALL",
        "region_vs_average": _REPORTING
        + f"""
        , t AS (SELECT Region, SUM(SaleAmount) AS s FROM r GROUP BY Region)
        , a AS (SELECT SUM(s) / COUNT(*) AS m FROM t)
        SELECT Region, CAST(s AS DOUBLE) AS TotalSales,
               ROUND(CAST(m AS DOUBLE), 2) AS AverageSales,
               ROUND(CAST(s AS DOUBLE) - CAST(m AS DOUBLE), 2) AS AboveAverage
        FROM t, a""",
        "cube_region_category": _REPORTING
        + f"""SELECT Region, Category, CAST(GROUPING_ID(Region, Category) AS INTEGER) AS GroupingId,
        {_TOTAL} FROM r GROUP BY CUBE (Region, Category)""",
    }
