"""The OLAP operators as SQL table functions over a reporting view.

``SELECT * FROM sales_slice_region(member => 'East')`` plans like the DataFrame operator: the body of
the function is expanded in place, so a member reaches the scan as a filter.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starfold.operators.star import register_view
from starfold.spec import SALES, CubeSpec


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _label(template: str) -> str:
    parts = []
    for literal, column, _, _ in Formatter().parse(template):
        parts += [_text(literal)] * bool(literal) + [f"CAST({_quoted(column)} AS STRING)"] * bool(column)
    return f"CONCAT({', '.join(parts)})"


def register_functions(
    spark: SparkSession, reporting: DataFrame, name: str = "sales", spec: CubeSpec = SALES
) -> list[str]:
    """Register ``reporting`` as the view ``name`` and, for this session, the functions

    * ``name_slice_DIMENSION(member)`` for each dimension: totals of a member by the other ones;
    * ``name_dice(DIMENSION => array, ...)``: totals of listed members, a list left out means all;
    * ``name_rollup()``: all levels and the grand total, as :func:`starfold.rollup_levels`;
    * ``name_drilldown(member)``: a top-level member, the latest if left out, and the levels below it.

    Results have the columns of the DataFrame operators, in no order; say ``ORDER BY``. The measure must
    be a decimal or a whole number, as SQL's sum of doubles depends on the order of rows. Returns the
    names of the functions. Registering again replaces them.
    """
    if isinstance(reporting.schema[spec.measure].dataType, (T.FloatType, T.DoubleType)):
        raise TypeError(f"{spec.measure} is a floating point measure; use the DataFrame operators")
    register_view(reporting, name)
    kind = {f.name: f.dataType.simpleString() for f in reporting.schema.fields}
    total = f"CAST(ROUND(SUM({_quoted(spec.measure)}), {spec.scale}) AS {spec.total_type}) AS {_quoted(spec.total)}"
    source, made = _quoted(name), []

    def columns(names) -> str:
        return ", ".join(map(_quoted, names))

    def returned(names, **types) -> str:
        every = {**{n: kind[n] for n in names}, **types, spec.total: spec.total_type}
        return ", ".join(f"{_quoted(n)} {t}" for n, t in every.items())

    def define(suffix: str, parameters: str, returns: str, body: str) -> None:
        function = f"{name}_{suffix}"
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {_quoted(function)}({parameters}) "
            f"RETURNS TABLE ({returns}) RETURN {body}"
        )
        made.append(function)

    for dimension in spec.dimensions:
        keys = [dimension, *[d for d in spec.dimensions if d != dimension]]
        define(
            f"slice_{dimension.lower()}", f"member {kind[dimension]}", returned(keys),
            f"SELECT {columns(keys)}, {total} FROM {source} "
            f"WHERE {_quoted(dimension)} <=> member GROUP BY {columns(keys)}",
        )
    # parameters are told from columns by their names
    lists = {d: f"of_{d.lower()}" for d in spec.dimensions}
    define(
        "dice", ", ".join(f"{p} ARRAY<{kind[d]}> DEFAULT NULL" for d, p in lists.items()), returned(spec.dimensions),
        f"SELECT {columns(spec.dimensions)}, {total} FROM {source} WHERE "
        + " AND ".join(f"({p} IS NULL OR ARRAY_CONTAINS({p}, {_quoted(d)}))" for d, p in lists.items())
        + f" GROUP BY {columns(spec.dimensions)}",
    )
    levels, depth = spec.hierarchy, len(spec.hierarchy)
    gid = f"GROUPING_ID({columns(levels)})"
    names = " ".join(
        f"WHEN {(1 << (depth - n)) - 1} THEN {_text(level.name)}" for n, level in enumerate(spec.levels, start=1)
    )
    define(
        "rollup", "", f"SummaryLevel STRING, {returned(levels)}",
        f"SELECT CASE {gid} {names} ELSE {_text(spec.all_name)} END, {columns(levels)}, {total} "
        f"FROM {source} GROUP BY ROLLUP ({columns(levels)})",
    )
    places = " ".join(f"WHEN {(1 << (depth - n)) - 1} THEN {n}" for n in range(1, depth + 1))
    labels = " ".join(
        f"WHEN {(1 << (depth - n)) - 1} THEN {_label(level.label)}" for n, level in enumerate(spec.levels, start=1)
    )
    sets = ", ".join(f"({columns(levels[:n])})" for n in range(1, depth + 1))
    top = _quoted(levels[0])
    define(
        "drilldown", f"member {kind[levels[0]]} DEFAULT NULL",
        f"SortLevel INT, DetailLevel STRING, PeriodLabel STRING, {returned(levels[1:])}",
        f"SELECT CASE {gid} {places} END, CASE {gid} {names} END, CASE {gid} {labels} END, "
        f"{columns(levels[1:])}, {total} FROM {source} "
        f"WHERE {top} = COALESCE(member, (SELECT MAX({top}) FROM {source})) GROUP BY GROUPING SETS ({sets})",
    )
    return made
