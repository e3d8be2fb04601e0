"""OLAP reporting on star schemas with PySpark DataFrames."""

from starfold.operators.checks import (
    duplicate_keys, observed_rows, orphan_facts, orphan_rows, require_columns, require_rows,
    row_count,
)
from starfold.operators.cube import (
    against_average, base_cuboid, compare_members, cube_by, dice_by, drill_at, drill_levels,
    grand_total, latest_member, latest_value, level_rows, restrict, restrict_latest, rollup_at,
    rollup_levels, slice_by, strongest_period, total_by, trend_by, with_period_label,
)
from starfold.operators.findings import headline_findings
from starfold.operators.profile import (
    duplicate_rows, missing_values, numeric_columns, numeric_summary, preview, sketch_check,
    structure, total_missing,
)
from starfold.operators.rank import strongest, top_bottom
from starfold.operators.star import attach_dimension, build_reporting, register_view
from starfold.operators.typed import column_profile, typed_summary
from starfold.sources import (
    DeltaMart, export_csv, failed_values, latest_partition, open_warehouse, read_csv, read_mart,
    read_reporting_csv, require_tables, sort_out_csv, write_bucketed, write_mart,
)
from starfold.spec import SALES, CubeSpec, Level

__all__ = [name for name in dir() if not name.startswith("_")]
