"""Slice, dice, roll-up, drill-down and the other cuts of a cube.

All operators sum one measure, and sums of sums are exact (see ``functions.measures``). Two things
follow, and both keep the work on the fact table to a single narrow aggregation:

* an operator with several levels first totals its finest level, then expands only those totals;
* the output of :func:`base_cuboid` can stand in for the detail in every operator here.

Order of results is always total: ties in the measure are broken by the group keys, and the place
of nulls is stated.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import combinations
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions import col, exact, level_label, rounded, summed, year_range
from starfold.functions.exact_floats import as_doubles, bin_of, rounded_sum, units_of
from starfold.spec import SALES, CubeSpec, Level

_SUM = "__sum"
_GID = "__gid"
#: Of a floating point measure: the bin whose units ``_SUM`` counts.
_BIN = "__bin"
_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


# -- restriction ---------------------------------------------------------------------------------


def member_test(column: str, members: Any) -> Column:
    """Equality with one member or membership in a list; ``None`` is the unknown member."""
    if isinstance(members, str) or not isinstance(members, Iterable):
        return col(column).isNull() if members is None else col(column) == members
    members = list(members)
    if not members:
        raise ValueError(f"no members given for dimension {column!r}")
    known = [m for m in members if m is not None]
    tests = [col(column).isin(known)] if known else []
    if len(known) < len(members):
        tests.append(col(column).isNull())
    return reduce(lambda a, b: a | b, tests)


def restrict(df: DataFrame, members: Mapping[str, Any], spec: CubeSpec = SALES) -> DataFrame:
    """Keep the detail of the given members, e.g. ``{"Region": ["East", "West"], "SalesYear": 2025}``.

    The result is detail again, so any other operator can run on it. Years are also expressed as
    a range on the date column, which reaches the scan where a function of the date cannot.
    """
    tests = [member_test(column, chosen) for column, chosen in members.items()]
    years = _years(members.get(spec.levels[0].column))
    if years and spec.date in df.columns and isinstance(df.schema[spec.date].dataType, _DATES):
        tests.append(year_range(col(spec.date), min(years), max(years)))
    return df.filter(reduce(and_, tests)) if tests else df


def _years(members: Any) -> list[int] | None:
    """The members as calendar years, if every one of them is one."""
    years = list(members) if isinstance(members, (list, tuple, set)) else [members]
    return years if all(type(y) is int and 1 <= y < 9999 for y in years) else None


def latest_member(df: DataFrame, level: str | None = None, spec: CubeSpec = SALES) -> DataFrame:
    """One row with the latest member of a level (the top one by default), null if there is none."""
    column = spec.levels[0].column if level is None else spec.level(level).column
    return df.agg(F.max(col(column)).alias("LatestMember"))


def latest_value(df: DataFrame, level: str | None = None, spec: CubeSpec = SALES) -> Any:
    """The latest member as a Python value. Runs a job; raises if there is no member."""
    value = latest_member(df, level, spec).first()["LatestMember"]
    if value is None:
        raise ValueError("no period was found in the data")
    return value


def restrict_latest(df: DataFrame, spec: CubeSpec = SALES) -> DataFrame:
    """Keep the latest top-level member, without a round trip through the driver.

    The member is found by a scalar subquery that reads one column; on a relation partitioned by
    that column only the latest partition is read afterwards.
    """
    return df.filter(col(spec.levels[0].column) == latest_member(df, spec=spec).scalar())


# -- totals --------------------------------------------------------------------------------------


def _is_floating(df: DataFrame, spec: CubeSpec) -> bool:
    return spec.float_as == "double" and isinstance(df.schema[spec.measure].dataType, (T.FloatType, T.DoubleType))


def _totals(df: DataFrame, keys: Sequence[str], spec: CubeSpec) -> DataFrame:
    """Sums that can be added up further, and are shown after :func:`_closed`. Those of a floating
    point measure have a row for each bin of a group."""
    grouped = [col(k) for k in keys]
    if not _is_floating(df, spec):
        return df.groupBy(*grouped).agg(summed(df, spec.measure, spec.float_as).alias(_SUM))
    value = df.select(*grouped, exact(df, spec.measure).alias("__value"))
    binned = value.select(*grouped, "__value", bin_of(F.col("__value")).alias(_BIN))
    units = units_of(F.col("__value"), F.col(_BIN))
    return binned.groupBy(*grouped, _BIN).agg(F.sum(units).alias(_SUM))


def _bins(totals: DataFrame) -> list[str]:
    return [_BIN] if _BIN in totals.columns else []


def _closed(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each group; the bins of a group, at most 263, are rounded to one double."""
    if not _bins(totals):
        return totals
    bins = F.collect_list(F.struct(F.col(_BIN).alias("bin"), F.col(_SUM).alias("units")))
    return totals.groupBy(*[col(k) for k in keys]).agg(rounded_sum(bins).alias(_SUM))


def _added(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals added up by fewer keys."""
    coarse = totals.groupBy(*[col(k) for k in [*keys, *_bins(totals)]]).agg(F.sum(_SUM).alias(_SUM))
    return _closed(coarse, keys)


def _expanded(totals: DataFrame, sets: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """Totals added up by each set of keys, with ``_GID``, the ``grouping_id`` over ``columns``."""
    bins = _bins(totals)
    every = [col(c) for c in [*columns, *bins]]
    grouped = totals.groupingSets([[col(c) for c in [*own, *bins]] for own in sets], *every)
    gid = F.shiftright(F.grouping_id(), len(bins)) if bins else F.grouping_id()
    added = grouped.agg(F.sum(_SUM).alias(_SUM), gid.alias(_GID))
    return _closed(added, [*columns, _GID])


def grouped_sum(df: DataFrame, keys: Sequence[str], spec: CubeSpec) -> DataFrame:
    """``keys`` and ``total``, exact or, of a floating point measure, rounded once."""
    return _closed(_totals(df, keys, spec), keys).withColumnRenamed(_SUM, "total")


def result(total: Column, spec: CubeSpec) -> Column:
    """An exact sum as it is shown."""
    return rounded(total, spec.scale, spec.total_type)


def _total_column(spec: CubeSpec) -> Column:
    return result(F.col(_SUM), spec).alias(spec.total)


def total_by(df: DataFrame, keys: Sequence[str], spec: CubeSpec = SALES) -> DataFrame:
    """Total per combination of any keys, unordered."""
    return _closed(_totals(df, keys, spec), keys).select(*[col(k) for k in keys], _total_column(spec))


def base_cuboid(
    df: DataFrame, keys: Sequence[str] | None = None, spec: CubeSpec = SALES
) -> DataFrame:
    """Pre-aggregate to the spec's grain, keeping the measure's name and its exact sum.

    Every operator gives the same result on this as on the detail, as long as it only uses
    ``keys``. Write it once with :func:`starfold.sources.mart.write_mart` and a whole report costs
    one pass over the facts. Of a floating point measure a group has some rows, two for each of its
    bins at most, whose doubles add up to the exact sum.
    """
    keys = spec.grain if keys is None else tuple(keys)
    if _is_floating(df, spec):
        parts = F.explode(as_doubles(F.col(_BIN), F.col(_SUM))).alias(spec.measure)
        return _totals(df, keys, spec).select(*[col(k) for k in keys], parts)
    return df.groupBy(*[col(k) for k in keys]).agg(summed(df, spec.measure, spec.float_as).alias(spec.measure))


def largest_first(df: DataFrame, keys: Sequence[str], spec: CubeSpec = SALES) -> DataFrame:
    return df.orderBy(
        F.desc_nulls_last(spec.total), *[col(k).asc_nulls_last() for k in keys]
    )


# -- slice and dice ------------------------------------------------------------------------------


def slice_by(
    df: DataFrame,
    dimension: str,
    member: Any,
    by: str | Sequence[str] | None = None,
    spec: CubeSpec = SALES,
) -> DataFrame:
    """Totals of one member, by the spec's other dimensions or by ``by``, in descending order. An
    unknown member gives an empty frame."""
    if by is None:
        by = [d for d in spec.dimensions if d != dimension]
    keys = [dimension, *([by] if isinstance(by, str) else by)]
    return largest_first(total_by(restrict(df, {dimension: member}, spec), keys, spec), keys, spec)


def dice_by(
    df: DataFrame, members: Mapping[str, Sequence[Any]], spec: CubeSpec = SALES
) -> DataFrame:
    """Restrict any number of dimensions to lists of members of any length and total every
    combination that occurs, largest first."""
    if not members:
        raise ValueError("a dice needs at least one dimension")
    keys = list(members)
    return largest_first(total_by(restrict(df, members, spec), keys, spec), keys, spec)


# -- roll-up -------------------------------------------------------------------------------------


def _by_prefix(depth: int) -> dict[int, int]:
    """``grouping_id`` of each prefix of ``depth`` hierarchy columns: prefix length -> id."""
    return {kept: (1 << (depth - kept)) - 1 for kept in range(depth + 1)}


def rollup_levels(df: DataFrame, spec: CubeSpec = SALES) -> DataFrame:
    """Totals of every level of the hierarchy and the grand total, each after its detail.

    A level is named from ``grouping_id``, never from a null key: an unknown date keeps its own
    member on each level and is not taken for the grand total. With no input rows Spark returns no
    row at all, not even a grand total; use :func:`grand_total` where one row is needed.
    """
    columns = spec.hierarchy
    totals = _totals(df, columns, spec)
    if _bins(totals):
        rolled = _expanded(totals, [columns[:n] for n in range(len(columns), -1, -1)], columns)
    else:
        rolled = totals.rollup(*[col(c) for c in columns]).agg(
            F.sum(_SUM).alias(_SUM), F.grouping_id().alias(_GID)
        )
    ids = _by_prefix(len(columns))
    name = F.when(F.col(_GID) == ids[0], spec.all_name)
    for depth, level in enumerate(spec.levels, start=1):
        name = name.when(F.col(_GID) == ids[depth], level.name)
    return rolled.orderBy(*[col(c).asc_nulls_last() for c in columns], F.col(_GID)).select(
        name.alias("SummaryLevel"), *[col(c) for c in columns], _total_column(spec)
    )


def grand_total(df: DataFrame, spec: CubeSpec = SALES) -> DataFrame:
    """Exactly one row; a null total if there is nothing to add."""
    return _closed(_totals(df, [], spec), []).select(
        F.lit(spec.all_name).alias("SummaryLevel"), _total_column(spec)
    )


def rollup_at(df: DataFrame, level: str | None = None, spec: CubeSpec = SALES) -> DataFrame:
    """Totals of a single level in period order; the top level by default."""
    chosen = spec.levels[0] if level is None else spec.level(level)
    keys = spec.hierarchy[: spec.levels.index(chosen) + 1]
    return total_by(df, keys, spec).orderBy(*[col(k).asc_nulls_last() for k in keys])


# -- drill-down ----------------------------------------------------------------------------------


def _path(member: Any, spec: CubeSpec) -> tuple[Any, ...]:
    path = tuple(member) if isinstance(member, (tuple, list)) else (member,)
    if not 1 <= len(path) <= len(spec.levels):
        raise ValueError(f"a drill-down path has 1 to {len(spec.levels)} members, not {len(path)}")
    return path


def _totals_under(df: DataFrame, member: Any, spec: CubeSpec) -> tuple[DataFrame, int]:
    """Totals of the finest level under a path of members, and the length of the path.

    With no member the latest one is taken from the totals themselves. Both sides of that join
    need the same columns of the same aggregation, so its shuffle is made once and read twice, and
    the facts are scanned once.
    """
    columns = spec.hierarchy
    if member is not None:
        path = _path(member, spec)
        return _totals(restrict(df, dict(zip(columns, path)), spec), columns, spec), len(path)
    top = col(columns[0])
    totals = _totals(df.filter(top.isNotNull()), columns, spec)
    latest = totals.agg(F.max(F.struct(top.alias("top"), F.col(_SUM)))["top"].alias("__latest"))
    # One row.
    return totals.join(F.broadcast(latest), top == F.col("__latest")).drop("__latest"), 1


def drill_levels(df: DataFrame, member: Any = None, spec: CubeSpec = SALES) -> DataFrame:
    """One member and every level below it: the year, its quarters, their months.

    ``member`` is a top-level member, a path such as ``(2025, 1)``, or ``None`` for the latest
    top-level member. All levels come from one aggregation by grouping sets. No row if the member
    does not occur. On a mart partitioned by the top level, pass ``restrict_latest(mart)`` for the
    latest member: only its partition is then read.
    """
    totals, fixed = _totals_under(df, member, spec)
    columns = spec.hierarchy
    prefixes = range(fixed, len(columns) + 1)
    expanded = _expanded(totals, [columns[:n] for n in prefixes], columns)
    ids = _by_prefix(len(columns))

    def per_level(value) -> Column:
        chain = None
        for position, n in enumerate(prefixes, start=1):
            test, out = F.col(_GID) == ids[n], value(position, spec.levels[n - 1])
            chain = F.when(test, out) if chain is None else chain.when(test, out)
        return chain

    below = columns[fixed:]
    return expanded.select(
        per_level(lambda position, level: F.lit(position)).alias("SortLevel"),
        per_level(lambda position, level: F.lit(level.name)).alias("DetailLevel"),
        per_level(lambda position, level: level_label(level.label)).alias("PeriodLabel"),
        *[col(c) for c in below],
        _total_column(spec),
    ).orderBy("SortLevel", *[col(c).asc_nulls_first() for c in below])


def _period_totals(
    df: DataFrame, member: Any, level: str | None, spec: CubeSpec
) -> tuple[DataFrame, str]:
    column = (spec.levels[-1] if level is None else spec.level(level)).column
    if member is not None:
        path = _path(member, spec)
        detail = restrict(df, dict(zip(spec.hierarchy, path)), spec)
        return total_by(detail, [column], spec), column
    totals, _ = _totals_under(df, None, spec)
    return _added(totals, [column]).select(col(column), _total_column(spec)), column


def drill_at(
    df: DataFrame, member: Any = None, level: str | None = None, spec: CubeSpec = SALES
) -> DataFrame:
    """Totals of a single level under a member, in period order; the finest level by default."""
    totals, column = _period_totals(df, member, level, spec)
    return totals.orderBy(col(column).asc_nulls_last())


def strongest_period(
    df: DataFrame, member: Any = None, level: str | None = None, spec: CubeSpec = SALES
) -> DataFrame:
    """The period of one level under a member with the largest total; the first on a tie."""
    totals, column = _period_totals(df, member, level, spec)
    return largest_first(totals, [column], spec).limit(1)


def level_rows(levels: DataFrame, level: str) -> DataFrame:
    """The rows of one level of a roll-up or drill-down result."""
    column = "SummaryLevel" if "SummaryLevel" in levels.columns else "DetailLevel"
    return levels.filter(F.col(column) == level)


def with_period_label(rolled: DataFrame, level: str, spec: CubeSpec = SALES) -> DataFrame:
    """Rows of one roll-up level with their readable period, e.g. ``2025-Q1``."""
    chosen: Level = spec.level(level)
    return level_rows(rolled, chosen.name).withColumn("PeriodLabel", level_label(chosen.label))


# -- further cuts --------------------------------------------------------------------------------


def cube_by(
    df: DataFrame, dimensions: Sequence[str] | None = None, spec: CubeSpec = SALES
) -> DataFrame:
    """Totals of every combination of the dimensions and of all their subtotals.

    ``GroupingId`` tells a subtotal from a null member: bit *i* is set if dimension *i*, counted
    from the right, is summed over.
    """
    keys = spec.dimensions if dimensions is None else tuple(dimensions)
    subsets = [own for n in range(len(keys), -1, -1) for own in combinations(keys, n)]
    cubed = _expanded(_totals(df, keys, spec), subsets, keys)
    number = F.col(_GID).cast("int").alias("GroupingId")
    return cubed.select(*[col(k) for k in keys], number, _total_column(spec)).orderBy(
        "GroupingId", *[col(k).asc_nulls_last() for k in keys]
    )


def compare_members(
    df: DataFrame, dimension: str, members: tuple[Any, Any], by: str, spec: CubeSpec = SALES
) -> DataFrame:
    """Two members side by side for every value of ``by``, and the first minus the second.

    The members are named, so no job is needed to find the columns of the pivot.
    """
    first, second = members
    totals = _totals(restrict(df, {dimension: list(members)}, spec), [by, dimension], spec)
    pivoted = (
        _closed(totals, [by, dimension])
        .groupBy(col(by))
        .pivot(dimension, [first, second])
        .agg(F.sum(_SUM))
    )
    zero = F.lit(0)
    difference = F.coalesce(col(str(first)), zero) - F.coalesce(col(str(second)), zero)
    return pivoted.select(
        col(by),
        *[result(col(str(m)), spec).alias(str(m)) for m in members],
        result(difference, spec).alias("Difference"),
    ).orderBy(col(by).asc_nulls_last())


def trend_by(
    df: DataFrame, dimension: str, level: str | None = None, spec: CubeSpec = SALES
) -> DataFrame:
    """A dimension's totals over the periods of one level, in order."""
    chosen = spec.levels[0] if level is None else spec.level(level)
    keys = (dimension, *spec.hierarchy[: spec.levels.index(chosen) + 1])
    return total_by(df, keys, spec).orderBy(*[col(k).asc_nulls_last() for k in keys])


def against_average(df: DataFrame, dimension: str, spec: CubeSpec = SALES) -> DataFrame:
    """Each member's total, the average of all members' totals, and the difference, largest first.

    The average is a scalar subquery over the same totals, so it needs no single-task window.
    """
    parts = _totals(df, [dimension], spec)
    totals = _closed(parts, [dimension])
    if _bins(parts):  # the members' totals are those of the whole; each was rounded already
        average = _added(parts, []).select(_SUM).scalar() / totals.agg(F.count(_SUM)).scalar()
    else:
        average = totals.agg(F.avg(_SUM)).scalar()
    compared = totals.withColumn("__average", average).select(
        col(dimension),
        _total_column(spec),
        result(F.col("__average"), spec).alias("AverageSales"),
        result(F.col(_SUM) - F.col("__average"), spec).alias("AboveAverage"),
    )
    return largest_first(compared, [dimension], spec)
