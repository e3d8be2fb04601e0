"""Statistics of columns in their own types: whole numbers and decimals take no way through doubles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions import col
from starfold.operators.profile import numeric_columns, suboctave

_FLOATS = (T.FloatType, T.DoubleType)
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _present(field: T.StructField) -> Column:
    """The column with NaN as missing."""
    return F.nanvl(col(field.name), F.lit(None)) if isinstance(field.dataType, _FLOATS) else col(field.name)


# -- everything that one scan can tell -----------------------------------------------------------


def column_profile(df: DataFrame, scale: int = 2) -> DataFrame:
    """``position, column, type, rows, missing, numeric, mean, std, min, max`` of every column, from
    one scan and one aggregation.

    Nulls and NaNs are missing and enter no statistic. ``mean`` and ``std`` (of a sample) are given
    for numbers; ``min`` and ``max`` for numbers, dates and times as the text of the value in its own
    type, so that no digit of a bigint or decimal is lost. An empty frame has its columns, with no
    rows.
    """
    parts = [F.count(F.lit(1)).alias("rows")]
    cells = []
    for i, f in enumerate(df.schema):
        value, number = _present(f), isinstance(f.dataType, T.NumericType)
        parts.append(F.count(value).alias(f"n{i}"))
        if number:
            parts += [F.avg(_addend(f)).alias(f"mean{i}"), F.stddev_samp(value.cast("double")).alias(f"std{i}")]
        if ordered := isinstance(f.dataType, _ORDERED):
            parts += [F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}")]
        cells.append(
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"), F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("missing"), F.lit(number).alias("numeric"),
                *[
                    (F.round(F.col(f"{s}{i}").cast("double"), scale) if number else F.lit(None).cast("double")).alias(s)
                    for s in ("mean", "std")
                ],
                *[(F.col(f"{s}{i}") if ordered else F.lit(None)).cast("string").alias(s) for s in ("min", "max")],
            )
        )
    return df.agg(*parts).select(F.inline(F.array(*cells))).orderBy("position")


def _addend(field: T.StructField) -> Column:
    """Whole numbers and short decimals are added exactly, others as doubles."""
    kind = field.dataType
    if isinstance(kind, T.IntegralType):
        return col(field.name).cast("decimal(20,0)")
    return col(field.name) if isinstance(kind, T.DecimalType) and kind.precision <= 28 else _present(field).cast("double")


# -- values at ranks -----------------------------------------------------------------------------

_STATISTICS = {"min": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max": 1.0}
_FANOUT = 4096
_ENOUGH = 1 << 20


def typed_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    statistics: dict[str, float] | None = None,
    enough: int = _ENOUGH,
) -> DataFrame:
    """Minimum, quartiles and maximum of numeric columns, each in its column's own type.

    One row per ``statistic`` and a column per column. The value at share ``p`` is the smallest that
    at least this share of the present values does not exceed, hence always a value of the data. It
    is null in a column without one.

    The values are found by counting, in jobs that run in this call. Values per fraction of a power
    of two are counted first; the part that holds a rank is cut again while it holds more than
    ``enough`` values and they differ by more than a double can tell. Parts are told apart by the
    difference to the smallest value of the part, in the column's type, so neighbours among large
    whole numbers are kept apart. Of each job one row per column and statistic comes back.
    """
    asked = _STATISTICS if statistics is None else statistics
    names = numeric_columns(df) if columns is None else list(columns)
    taken = "statistic" if "statistic" not in {n.lower() for n in names} else "_statistic"
    values = df.select(*[_present(df.schema[n]).alias(n) for n in names])
    kinds = list(dict.fromkeys(f.dataType for f in values.schema))
    cells = _Cells(values, kinds)
    found: dict[tuple[int, int], Any] = {}
    brackets = cells.survey(list(asked.values())) if names else []
    while brackets:
        open_ = []
        for b in brackets:
            if b["rank"] == b["before"] or b["low"] == b["high"]:
                found[b["position"], b["quantile"]] = b["low"]
            elif b["rank"] == b["before"] + b["n"] - 1:
                found[b["position"], b["quantile"]] = b["high"]
            else:
                open_.append(b)
        wide = [b for b in open_ if b["n"] > enough and b["width"] > 0]
        few = [b for b in open_ if b not in wide]
        brackets = (cells.narrow(wide) if wide else []) + (cells.pick(few) if few else [])
    schema = T.StructType([T.StructField(taken, T.StringType()), *[T.StructField(f.name, f.dataType) for f in values.schema]])
    rows = [[s, *[found.get((j, i)) for j in range(len(names))]] for i, s in enumerate(asked)]
    return _inline(df.sparkSession, rows, schema)


def _literal(value: Any, kind: T.DataType) -> Column:
    """Through text, which spells every number exactly; a literal's type would follow its digits."""
    if value is None:
        return F.lit(None).cast(kind)
    return F.lit(format(value, "f") if isinstance(kind, T.DecimalType) else str(value)).cast(kind)


def _inline(spark: SparkSession, rows: list[list], schema: T.StructType) -> DataFrame:
    """A few rows as part of the plan."""
    structs = [F.struct(*[_literal(v, f.dataType).alias(f"c{i}") for i, (v, f) in enumerate(zip(row, schema))]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).toDF(*schema.names)


class _Cells:
    """Columns as rows ``position, v0, v1, ...``, with a field per type, one of which is set."""

    def __init__(self, values: DataFrame, kinds: list[T.DataType]):
        self.values, self.kinds = values, kinds
        self.v = [f"v{i}" for i in range(len(kinds))]
        self.kind_of = [kinds.index(f.dataType) for f in values.schema]

    def _rows(self, values: DataFrame) -> DataFrame:
        cells = [
            F.struct(
                F.lit(j).alias("position"),
                *[(col(f.name) if k == f.dataType else F.lit(None).cast(k)).alias(v) for v, k in zip(self.v, self.kinds)],
            )
            for j, f in enumerate(values.schema)
        ]
        return values.select(F.inline(F.array(*cells))).filter(self._any(F.col).isNotNull())

    def _any(self, of) -> Column:
        """The one that is set, as a double."""
        return F.coalesce(*[of(v).cast("double") for v in self.v])

    def _sizes(self) -> list[Column]:
        return [
            F.count(F.lit(1)).alias("n"),
            *[a for v in self.v for a in (F.min(v).alias(f"low_{v}"), F.max(v).alias(f"high_{v}"))],
        ]

    def _brackets(self, held: DataFrame) -> list[dict]:
        width = self._any(lambda v: F.col(f"high_{v}") - F.col(f"low_{v}"))
        found = []
        for row in held.select("*", width.alias("width")).collect():
            v = self.v[self.kind_of[row.position]]
            place = {n: row[n] for n in ("position", "quantile", "rank", "before", "n", "width")}
            found.append(place | {"low": row[f"low_{v}"], "high": row[f"high_{v}"]})
        return found

    def survey(self, shares: list[float]) -> list[dict]:
        bucket = suboctave(self._any(F.col)).alias("bucket")
        parts = self._rows(self.values).groupBy("position", bucket).agg(*self._sizes())
        column = Window.partitionBy("position")
        ranks = F.array(
            *[
                F.struct(
                    F.lit(i).alias("quantile"),
                    F.greatest(F.ceil(F.col("total") * F.lit(p)) - 1, F.lit(0)).cast("bigint").alias("rank"),
                )
                for i, p in enumerate(shares)
            ]
        )
        placed = parts.select(
            "*",
            F.sum("n").over(column).alias("total"),
            (F.sum("n").over(column.orderBy("bucket")) - F.col("n")).alias("before"),
        )
        return self._brackets(placed.select("*", F.inline(ranks)).filter(_HOLDS))

    def _inside(self, brackets: list[dict]) -> DataFrame:
        """Values that lie in a bracket, with that bracket. The filter on whole columns reaches the
        scan; the brackets, one per column and statistic at most, have a fixed size."""
        names = self.values.columns
        reach = [
            col(names[b["position"]]).between(*[_literal(b[end], self.kinds[self.kind_of[b["position"]]]) for end in ("low", "high")])
            for b in brackets
        ]
        schema = T.StructType(
            [T.StructField("position", T.IntegerType()), T.StructField("quantile", T.IntegerType()),
             T.StructField("rank", T.LongType()), T.StructField("before", T.LongType()),
             T.StructField("width", T.DoubleType()),
             *[T.StructField(f"{end}_{v}", k) for v, k in zip(self.v, self.kinds) for end in ("from", "to")]]
        )
        known = []
        for b in brackets:
            ends = [b[end] if i == self.kind_of[b["position"]] else None for i in range(len(self.v)) for end in ("low", "high")]
            known.append([b["position"], b["quantile"], b["rank"], b["before"], b["width"], *ends])
        known = _inline(self.values.sparkSession, known, schema)
        within = reduce(or_, [F.coalesce(F.col(v).between(F.col(f"from_{v}"), F.col(f"to_{v}")), F.lit(False)) for v in self.v])
        return self._rows(self.values.filter(reduce(or_, reach))).join(F.broadcast(known), "position").filter(within)

    def narrow(self, brackets: list[dict]) -> list[dict]:
        above = self._any(lambda v: F.col(v) - F.col(f"from_{v}"))
        part = F.floor(above / F.col("width") * _FANOUT).alias("part")
        return self._counted(brackets, [part], ["part"])

    def pick(self, brackets: list[dict]) -> list[dict]:
        """Count single values."""
        same = [F.col(v).alias(f"at_{v}") for v in self.v]
        return self._counted(brackets, same, [f"at_{v}" for v in self.v])

    def _counted(self, brackets: list[dict], keys: list[Column], order: list[str]) -> list[dict]:
        place = ("position", "quantile", "rank", "before")
        counted = self._inside(brackets).groupBy(*place, *keys).agg(*self._sizes())
        ordered = Window.partitionBy("position", "quantile").orderBy(*order)
        placed = counted.withColumn("before", F.col("before") + F.sum("n").over(ordered) - F.col("n"))
        return self._brackets(placed.filter(_HOLDS))


_HOLDS = "before <= rank AND rank < before + n"
