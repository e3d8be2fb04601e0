"""The whole sales report: from warehouse tables to files and result frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from starfold.functions import composite_label
from starfold.operators.checks import observed_rows, require_rows
from starfold.operators.cube import (
    base_cuboid,
    dice_by,
    drill_at,
    drill_levels,
    latest_value,
    level_rows,
    restrict,
    rollup_at,
    rollup_levels,
    slice_by,
    with_period_label,
)
from starfold.operators.findings import headline_findings
from starfold.operators.rank import top_bottom
from starfold.operators.star import build_reporting, period_columns, register_view
from starfold.schema import MART_CLUSTER, schema_of
from starfold.sources import export_csv, open_warehouse, read_mart, write_mart
from starfold.spec import SALES, CubeSpec


@dataclass(frozen=True)
class Questions:
    """What a report asks. ``member`` is the period to drill into, the latest one if not given."""

    slice_on: tuple[str, Any] = ("Region", "East")
    dice_on: Mapping[str, Sequence[Any]] | None = None
    member: Any = None
    top_n: int = 5

    def dice(self) -> Mapping[str, Sequence[Any]]:
        return self.dice_on or {"Region": ("East", "West"), "Category": ("Clothing", "Electronics")}


def answers(df: DataFrame, ask: Questions, spec: CubeSpec = SALES) -> dict[str, DataFrame]:
    """Every result frame of a report, lazily, on detail or on a base cuboid."""
    diced = dice_by(df, ask.dice(), spec)
    rolled = rollup_levels(df, spec)
    drilled = drill_levels(df, ask.member, spec)
    finest = spec.levels[-1]
    return {
        "slice": slice_by(df, *ask.slice_on, spec=spec),
        "dice": diced.withColumn("Label", composite_label(list(ask.dice()))),
        "rollup": rolled,
        "rollup_yearly": rollup_at(df, spec=spec),
        "quarterly_trend": with_period_label(rolled, spec.levels[-2].name, spec),
        "drilldown": drilled,
        "monthly_trend": level_rows(drilled, finest.name),
        "drilldown_monthly": drill_at(df, ask.member, spec=spec),
        "top_bottom": top_bottom(df, n=ask.top_n, spec=spec),
        "findings": headline_findings(df, ask.slice_on, ask.dice(), ask.member, spec),
    }


def write_answers(results: Mapping[str, DataFrame], output: str) -> dict[str, str]:
    """Every row of every result, in its order, as CSV under ``output``/answers; the paths."""
    paths = {name: f"{output}/answers/{name}" for name in results}
    for name, frame in results.items():
        frame.write.mode("overwrite").options(header=True, escape='"').csv(paths[name])
    return paths


def require_answers(df: DataFrame, ask: Questions, spec: CubeSpec = SALES) -> None:
    """Raise if a selection matches nothing."""
    member = latest_value(df, spec=spec) if ask.member is None else ask.member
    selections = {
        "slice": dict([ask.slice_on]),
        "dice": ask.dice(),
        "drill-down": {spec.levels[0].column: member},
    }
    for name, members in selections.items():
        require_rows(restrict(df, members, spec), f"the {name} selects no rows: {dict(members)}")


def run(
    spark: SparkSession, warehouse: str, output: str, ask: Questions = Questions()
) -> tuple[dict[str, DataFrame], int]:
    """Warehouse in, files and answers out; also the number of reporting rows.

    The star join runs once, to write the mart. The CSV extract and the cuboid are made from the
    mart, and all answers from the cuboid. The rows are counted while the mart is written.
    """
    tables = open_warehouse(spark, warehouse)
    reporting = build_reporting(
        tables["fact_sales"], tables["dim_customers"], tables["dim_products"]
    )
    counted, observation = observed_rows(reporting)
    write_mart(counted, f"{output}/mart", cluster=MART_CLUSTER, rebalance=False)
    mart = register_view(read_mart(spark, f"{output}/mart", schema_of(reporting)))
    export_csv(mart, f"{output}/sales_reporting_csv", derived=period_columns())
    cuboid = base_cuboid(mart)
    write_mart(cuboid, f"{output}/cuboid")
    summary = read_mart(spark, f"{output}/cuboid", schema_of(cuboid))
    require_answers(summary, ask)
    return answers(summary, ask), observation.get["rows"]
