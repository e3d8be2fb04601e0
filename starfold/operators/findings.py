"""Headline findings of a report as rows, from one pass over the facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions import col, currency
from starfold.functions.columns import NULL_TEXT
from starfold.operators.cube import base_cuboid, grouped_sum, member_test, result
from starfold.spec import SALES, CubeSpec


def headline_findings(
    df: DataFrame,
    slice_on: tuple[str, Any],
    dice_on: Mapping[str, Sequence[Any]],
    member: Any = None,
    spec: CubeSpec = SALES,
) -> DataFrame:
    """Leading group of the slice, strongest cell of the dice, grand total, strongest top-level
    period, and strongest finest period of ``member`` (the latest top-level period by default).

    The questions have different filters, so asking them one by one would scan and join the facts
    five times. Here the facts are reduced to the base cuboid once; each of its rows then says
    which questions it counts for, and an arg-min over an ordered struct picks the winners. That
    combines partially like any aggregate: no sort, no window, no group gathered in one task.
    """
    top, finest = spec.levels[0], spec.levels[-1]
    dimension, chosen = slice_on
    by = [d for d in spec.dimensions if d != dimension]
    cuboid = base_cuboid(
        df, dict.fromkeys((*spec.dimensions, dimension, *dice_on, *spec.hierarchy)), spec
    )

    dice_test = F.lit(True)
    for column, members in dice_on.items():
        dice_test = dice_test & member_test(column, members)
    no_period = F.lit(None).cast(df.schema[top.column].dataType)
    in_period = col(top.column).isNotNull() if member is None else col(top.column) == member
    total_name = "rollup_total"
    asked_for = [
        ("slice", by, member_test(dimension, chosen), no_period),
        ("dice", list(dice_on), dice_test, no_period),
        (total_name, [], F.lit(True), no_period),
        (f"rollup_{top.name.lower()}", [top.column], col(top.column).isNotNull(), no_period),
        (f"drilldown_{finest.name.lower()}", [finest.column], in_period, col(top.column)),
    ]

    def in_order(number: int) -> Column:
        """The keys of each question with their own types, nulls last; those of others are null."""
        fields = []
        for i, (_, keys, _, _) in enumerate(asked_for, start=1):
            own = [f for k in keys for f in (col(k).isNull(), col(k))] or [F.lit(0)]
            own = F.struct(*[f.alias(f"f{j}") for j, f in enumerate(own)])
            fields.append(F.when(F.lit(i == number), own).alias(f"q{i}"))
        return F.struct(*fields)

    def question(number: int, name: str, keys: Sequence[str], test: Column, period: Column) -> Column:
        texts = [col(k).cast("string") for k in keys] or [F.lit(spec.all_name)]
        return F.when(
            test,
            F.struct(
                F.lit(number).alias("number"),
                F.lit(name).alias("finding"),
                period.alias("period"),
                F.array(*texts).alias("member"),
                in_order(number).alias("keys"),
            ),
        )

    questions = [question(i, *q) for i, q in enumerate(asked_for, start=1)]
    asked = cuboid.select(
        F.explode(F.array_compact(F.array(*questions))).alias("q"), col(spec.measure)
    ).select("q.*", col(spec.measure))
    # The grand total has a row even where nothing else has: one without an amount always counts.
    empty = {
        "number": F.lit(3), "finding": F.lit(total_name), "member": F.array(F.lit(spec.all_name)),
    }
    kind = asked.schema["keys"].dataType
    nothing = [
        F.struct(F.lit(0).alias("f0")).cast(f.dataType) if f.name == "q3" else F.lit(None).cast(f.dataType)
        for f in kind.fields
    ]
    empty["keys"] = F.struct(*[c.alias(f.name) for c, f in zip(nothing, kind.fields, strict=True)])
    seed = df.sparkSession.range(1).select(
        *[
            empty.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in asked.schema.fields
        ]
    )
    asked = asked.unionByName(seed)
    totals = grouped_sum(asked, ["number", "finding", "period", "member", "keys"], spec)
    # Within a period the smallest struct wins, by the order of the operators themselves: known
    # before unknown, largest total as it is shown, first keys.
    shown = result(F.col("total"), spec)
    winner = F.min(
        F.struct(
            F.col("total").isNull().alias("unknown"),
            (-shown).alias("order"),
            F.col("keys"),
            F.col("member"),
            F.col("total"),
        )
    )
    per_period = totals.groupBy("number", "finding", "period").agg(winner.alias("best"))
    latest = per_period.groupBy("number", "finding").agg(
        F.max(F.struct("period", "best"))["best"].alias("w")
    )
    label = F.array_join("w.member", " / ", NULL_TEXT)
    return (
        latest.orderBy("number")
        .select(
            F.col("number").alias("FindingNo"),
            F.col("finding").alias("Finding"),
            label.alias("Member"),
            result(F.col("w.total"), spec).alias(spec.total),
            F.concat(label, F.lit(" ("), currency(F.col("w.total")), F.lit(")")).alias("Text"),
        )
    )
