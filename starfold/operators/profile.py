"""Data profiling as Spark jobs that return DataFrames."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions import col

_FLOATS = (T.FloatType, T.DoubleType)


def structure(df: DataFrame) -> DataFrame:
    """Position, name and type of every column, with the number of rows."""
    described = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema, start=1)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("rows"))
        .select(F.explode(described).alias("c"), "rows")
        .select("c.*", "rows")
        .orderBy("position")
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.limit(n)


# -- missing values and duplicates ---------------------------------------------------------------


def _is_missing(field: T.StructField) -> Column:
    c = col(field.name)
    return c.isNull() | F.isnan(c) if isinstance(field.dataType, _FLOATS) else c.isNull()


def missing_values(df: DataFrame, only_present: bool = True) -> DataFrame:
    """Nulls and NaNs per column, in one pass; columns without any are left out by default."""
    counts = df.agg(
        *[F.count_if(_is_missing(f)).alias(f"m{i}") for i, f in enumerate(df.schema)]
    )
    rows = counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                             F.col(f"m{i}").alias("missing"))
                    for i, f in enumerate(df.schema)
                ]
            )
        ).alias("c")
    ).select("c.*")
    if only_present:
        rows = rows.filter(F.col("missing") > 0)
    return rows.orderBy("position")


def total_missing(df: DataFrame) -> DataFrame:
    return missing_values(df, only_present=False).agg(F.sum("missing").alias("missing"))


def _group_key(field: T.StructField) -> Column:
    """Texts and bytes by their digest, whatever their length. Texts of a collation that takes
    different bytes for equal are grouped as they are, by Spark's own rule."""
    c = col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.sha2(c, 256) if field.dataType == T.StringType() else c
    return F.sha2(c, 256) if isinstance(field.dataType, T.BinaryType) else c


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and duplicates (all but the first of each group of equal rows), by all
    columns or by ``subset``.

    Nulls equal each other, and so do NaNs. Equal rows are merged where they are read, so a row
    repeated any number of times crosses the network once per task. Whole texts are compared, but
    travel as SHA-256 digests.
    """
    chosen = df.columns if subset is None else subset
    keys = [_group_key(df.schema[c]).alias(f"k{i}") for i, c in enumerate(chosen)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
    )


# -- numeric summary -----------------------------------------------------------------------------


_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
_STATISTICS = ("count", "mean", "std", "min", "max")
_SUMMARY = (
    "column string, count bigint, mean double, std double, min double, p25 double, p50 double, "
    "p75 double, max double"
)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of numeric type, booleans excluded."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "exact",
    scale: int = 2,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each numeric column.

    Missing values are skipped. Quartiles interpolate linearly between neighbouring values.
    ``method="exact"`` finds them by counting (see :func:`quantiles`), usually in two passes over
    the numeric columns; ``"approx"`` merges small sketches in one pass. A frame without numeric
    columns or without rows gives no rows.
    """
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown method {method!r}")
    chosen = numeric_columns(df) if columns is None else list(columns)
    if not chosen:
        return df.sparkSession.createDataFrame([], _SUMMARY)
    values = df.select(*[_as_double(df, c).alias(c) for c in chosen])
    summary = (_exact_summary if method == "exact" else _sketched_summary)(values)
    names = F.array(*[F.lit(c) for c in chosen])
    return summary.orderBy("position").select(
        names[F.col("position")].alias("column"),
        "count",
        *[F.round(c, scale).alias(c) for c in ("mean", "std", "min", *_QUARTILES, "max")],
    )


def _as_double(df: DataFrame, name: str) -> Column:
    c = col(name).cast("double")
    return F.nanvl(c, F.lit(None)) if isinstance(df.schema[name].dataType, _FLOATS) else c


def _long(values: DataFrame) -> DataFrame:
    """One row per column position and value, nulls included."""
    every = F.array(*[col(c) for c in values.columns])
    return values.select(F.posexplode(every).alias("position", "value"))


def _sizes() -> list[Column]:
    return [F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]


def _part_moments() -> list[Column]:
    return [*_sizes(), F.avg("value").alias("part_mean"), F.var_pop("value").alias("part_var")]


def _with_whole_mean(parts: DataFrame) -> DataFrame:
    """Add each column's count and mean to its parts."""
    whole = Window.partitionBy("position")
    total = F.sum("n").over(whole)
    weighted = F.sum(F.col("n") * F.col("part_mean")).over(whole)
    return parts.select("*", total.alias("total"), F.try_divide(weighted, total).alias("mean"))


def _merged_moments() -> list[Column]:
    """Statistics of a column from those of its parts; squares are taken around the whole mean."""
    apart = F.col("part_mean") - F.col("mean")
    squares = F.sum(F.col("n") * (F.col("part_var") + apart * apart))
    total = F.max("total")
    return [
        total.alias("count"),
        F.max("mean").alias("mean"),
        F.when(total > 1, F.sqrt(squares / (total - 1))).alias("std"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
    ]


def _exact_summary(values: DataFrame) -> DataFrame:
    surveyed = _survey(values, _QUARTILES)
    statistics = _local(
        values,
        [{k: row[k] for k in ("position", *_STATISTICS)} for row in surveyed],
        [("position", pa.int32()), ("count", pa.int64())]
        + [(k, pa.float64()) for k in _STATISTICS[1:]],
    )
    # Both sides have one row per column.
    return statistics.join(
        F.broadcast(_settle(values, surveyed, _QUARTILES, _ENOUGH)), "position", "left"
    )


# -- quantiles by counting -----------------------------------------------------------------------

# A bracket is cut into this many parts each time it is narrowed, until it holds no more values
# than one task should sort.
_FANOUT = 4096
_ENOUGH = 1 << 20
_SUBOCTAVES = 16


def quantiles(
    values: DataFrame, probabilities: dict[str, float], enough: int = _ENOUGH
) -> DataFrame:
    """Exact interpolated quantiles of every column of a frame of doubles, by counting.

    One row per ``position`` of a column, from 0, with a value per named probability.

    ``percentile`` would gather a map of all distinct values in one task. Instead the rank of each
    quantile is bracketed: count values per fraction of a power of two, keep the bucket that holds
    the rank, cut it into equal parts and count again while it holds too many values. Tasks send
    bucket counts, not values. A double has 52 bits of fraction and each cut settles 12 of them, so
    few cuts are ever made, and what is left to sort is ``enough`` values per bracket, or a single
    one repeated any number of times.

    The cuts are jobs that run in this call. Of each, one row per column and quantile comes back.
    """
    return _settle(values, _survey(values, probabilities), probabilities, enough)


# A bracket belongs to one quantile of one column: ``at`` is its place among the sorted values and
# ``rank`` the whole number below. ``before`` counts the values below the bracket, ``n`` those
# inside; ``next`` is the smallest value above it.
_QUANTILE = ("position", "quantile", "at", "rank")
_SPAN = ("low", "high", "before", "n", "next")
_BRACKET_TYPES = {
    "position": pa.int32(), "quantile": pa.int32(), "at": pa.float64(), "rank": pa.int64(),
    "low": pa.float64(), "high": pa.float64(), "before": pa.int64(), "next": pa.float64(),
}


def _local(values: DataFrame, rows: list[dict], types: list) -> DataFrame:
    """From Arrow, rows become part of the plan; from Python objects they would be a Python RDD."""
    return values.sparkSession.createDataFrame(pa.Table.from_pylist(rows, pa.schema(types)))


def _holds(rank: Column) -> Column:
    return (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))


def suboctave(value: Column) -> Column:
    """The bucket of a double: the larger the value, the larger the bucket."""
    magnitude = F.abs(value)
    # Grows with the magnitude; the offset keeps it positive down to the smallest double.
    octave = F.when(magnitude == float("inf"), 1024 * _SUBOCTAVES).otherwise(
        F.floor(F.log2(magnitude) * _SUBOCTAVES).cast("int")
    ) + F.lit(1100 * _SUBOCTAVES)
    return F.when(value == 0, 0).otherwise(F.signum(value).cast("int") * octave)


def _survey(values: DataFrame, probabilities: dict[str, float]) -> list[Row]:
    """First pass: statistics of each column, and the bucket of each quantile among at most 70,000
    per column. One row per column, no row for an empty frame."""
    ordered = Window.partitionBy("position").orderBy("bucket")
    bucket = suboctave(F.col("value")).alias("bucket")
    parts = _long(values).groupBy("position", bucket).agg(*_part_moments())
    placed = _with_whole_mean(parts).select(
        "*",
        (F.sum("n").over(ordered) - F.col("n")).alias("before"),
        F.lead("low").over(ordered).alias("next"),
    )
    spans = [
        F.max(F.when(_holds(F.floor((F.col("total") - 1) * F.lit(p))), F.struct(*_SPAN))).alias(
            f"span{i}"
        )
        for i, p in enumerate(probabilities.values())
    ]
    return placed.groupBy("position").agg(*_merged_moments(), *spans).collect()


def _settle(
    values: DataFrame, surveyed: list[Row], probabilities: dict[str, float], enough: int
) -> DataFrame:
    """Narrow the surveyed brackets as far as needed, then read the quantiles from them."""
    brackets = []
    for row in surveyed:
        for i, p in enumerate(probabilities.values()):
            if row[f"span{i}"] is not None:
                at = (row["count"] - 1) * p
                place = {"position": row.position, "quantile": i, "at": at, "rank": math.floor(at)}
                brackets.append(place | row[f"span{i}"].asDict())
    while wide := [b for b in brackets if b["n"] > enough and b["low"] < b["high"]]:
        narrowed = _narrow(values, wide).collect()
        brackets = [b for b in brackets if b not in wide] + [b.asDict() for b in narrowed]
    if not brackets:
        schema = ", ".join(["position int", *[f"`{name}` double" for name in probabilities]])
        return values.sparkSession.createDataFrame([], schema)
    found = _pick(values, brackets)
    fraction = F.col("at") - F.col("rank")
    interpolated = F.when(
        (fraction > 0) & (F.col("next") > F.col("value")),
        F.col("value") + (F.col("next") - F.col("value")) * fraction,
    ).otherwise(F.col("value"))
    return found.groupBy("position").agg(
        *[
            F.max(F.when(F.col("quantile") == i, interpolated)).alias(name)
            for i, name in enumerate(probabilities)
        ]
    )


def _inside(values: DataFrame, brackets: list[dict]) -> DataFrame:
    """Values that lie in a bracket, with that bracket. There is one bracket per column and
    quantile, so what is broadcast has a fixed size. A plain filter first leaves the values that are
    in any of them, so the join multiplies only these."""
    in_any = reduce(
        or_,
        [
            (F.col("position") == b["position"]) & F.col("value").between(F.lit(b["low"]), F.lit(b["high"]))
            for b in brackets
        ],
    )
    known = [{n: b[n] for n in _BRACKET_TYPES} for b in brackets]
    known = _local(values, known, list(_BRACKET_TYPES.items()))
    return _long(values).filter(in_any).join(F.broadcast(known), "position").filter(
        F.col("value").between(F.col("low"), F.col("high"))
    )


def _narrow(values: DataFrame, brackets: list[dict]) -> DataFrame:
    width = F.col("high") - F.col("low")
    part = F.when(width > 0, F.floor((F.col("value") - F.col("low")) / width * _FANOUT)).otherwise(0)
    counted = (
        _inside(values, brackets)
        .groupBy(*_QUANTILE, "before", "next", part.alias("part"))
        .agg(*_sizes())
    )
    ordered = Window.partitionBy(*_QUANTILE).orderBy("part")
    return counted.withColumns(
        {
            "before": F.col("before") + F.sum("n").over(ordered) - F.col("n"),
            "next": F.coalesce(F.lead("low").over(ordered), F.col("next")),
        }
    ).filter(_holds(F.col("rank"))).select(*_QUANTILE, *_SPAN)


def _pick(values: DataFrame, brackets: list[dict]) -> DataFrame:
    """The value at each rank, and the one after it."""
    counted = (
        _inside(values, brackets)
        .groupBy(*_QUANTILE, "before", "next", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = Window.partitionBy(*_QUANTILE).orderBy("value")
    last_copy = F.col("rank") == F.col("before") + F.col("n") - 1
    return counted.withColumns(
        {
            "before": F.col("before") + F.sum("n").over(ordered) - F.col("n"),
            "next": F.coalesce(F.lead("value").over(ordered), F.col("next")),
        }
    ).filter(_holds(F.col("rank"))).select(
        *_QUANTILE, "value", F.when(last_copy, F.col("next")).otherwise(F.col("value")).alias("next")
    )


# -- quantiles by sketches -----------------------------------------------------------------------

_SKETCH_GROUPS = 64
_SKETCH_SIZE = 800


def _sketched_summary(values: DataFrame) -> DataFrame:
    """One pass over the columns side by side. Sketches are merged in two steps, so that no task
    takes in those of all others. Quartiles are values whose rank is close, not interpolated."""
    columns = range(len(values.columns))
    parts = values.groupBy((F.spark_partition_id() % _SKETCH_GROUPS).alias("group")).agg(
        *[
            part
            for i in columns
            for c in [col(values.columns[i])]
            for part in (
                F.count(c).alias(f"n{i}"), F.min(c).alias(f"low{i}"), F.max(c).alias(f"high{i}"),
                F.avg(c).alias(f"part_mean{i}"), F.var_pop(c).alias(f"part_var{i}"),
                F.kll_sketch_agg_double(c, _SKETCH_SIZE).alias(f"sketch{i}"),
            )
        ]
    )
    names = ("n", "low", "high", "part_mean", "part_var", "sketch")
    each = F.array(
        *[F.struct(F.lit(i).alias("position"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i in columns]
    )
    parts = parts.select(F.explode(each).alias("p")).select("p.*")
    merged = _with_whole_mean(parts).groupBy("position").agg(
        *_merged_moments(), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(
        "position",
        *_STATISTICS,
        *[
            F.when(
                F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))
            ).alias(name)
            for name, p in _QUARTILES.items()
        ],
    )


def sketch_check(df: DataFrame, error: float = 0.02) -> DataFrame:
    """``column, quantile, enclosed``: whether the share of values below an approximate quartile and
    the share up to it enclose its probability, give or take ``error``. Sketches promise ranks, not
    values. The quartiles are one row, which every row of ``df`` is counted against."""
    chosen = numeric_columns(df)
    values = df.select(*[_as_double(df, c).alias(c) for c in chosen])
    found = {r["position"]: r for r in _sketched_summary(values).collect()}
    asked = [(i, q) for i in range(len(chosen)) for q in _QUARTILES if found and found[i][q] is not None]
    shares = [
        F.struct(
            F.lit(chosen[i]).alias("column"), F.lit(q).alias("quantile"),
            (
                (F.count_if(col(chosen[i]) < found[i][q]) <= (_QUARTILES[q] + error) * F.count(col(chosen[i])))
                & (F.count_if(col(chosen[i]) <= found[i][q]) >= (_QUARTILES[q] - error) * F.count(col(chosen[i])))
            ).alias("enclosed"),
        )
        for i, q in asked
    ]
    if not shares:
        return df.sparkSession.createDataFrame([], "column string, quantile string, enclosed boolean")
    return values.agg(F.array(*shares).alias("s")).select(F.explode("s").alias("s")).select("s.*")
