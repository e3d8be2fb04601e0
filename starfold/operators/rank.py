"""Largest and smallest groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions import col, composite_label
from starfold.functions.columns import NULL_TEXT
from starfold.operators.cube import largest_first, total_by
from starfold.spec import SALES, CubeSpec


def strongest(df: DataFrame, keys: str | Sequence[str], spec: CubeSpec = SALES) -> DataFrame:
    """The group with the largest total; the first in key order on a tie. No row on no input."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return largest_first(total_by(df, keys, spec), keys, spec).limit(1)


def top_bottom(
    df: DataFrame,
    by: str | Sequence[str] | None = None,
    n: int = 5,
    spec: CubeSpec = SALES,
    null_text: str | None = NULL_TEXT,
    ascending: bool = False,
) -> DataFrame:
    """The ``n`` largest and ``n`` smallest groups, a missing total counting as 0.

    Each side is a top-k over the same totals: a task keeps ``n`` rows of its partition, so neither
    a full sort nor the list of all groups is ever built, however many groups there are. With
    fewer than ``n`` groups a side holds all of them. Rows come in rank order, or, for horizontal
    bars, with ``ascending`` from small to large on both sides.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    by = spec.dimensions if by is None else by
    keys = [by] if isinstance(by, str) else list(by)
    zero = F.lit(0).cast(spec.total_type)
    totals = total_by(df, keys, spec).withColumn(spec.total, F.coalesce(spec.total, zero))

    def side(name: str, best: str) -> DataFrame:
        order = F.desc(spec.total) if best == "largest" else F.asc(spec.total)
        return (
            totals.orderBy(order, *[col(k).asc_nulls_last() for k in keys])
            .limit(n)
            .withColumn("Side", F.lit(name))
            .withColumn("__place", -F.col(spec.total) if best == "largest" else F.col(spec.total))
        )

    # The window sees at most 2n rows.
    placed = Window.partitionBy("Side").orderBy("__place", *[col(k).asc_nulls_last() for k in keys])
    ranked = (
        side("Top", "largest")
        .unionByName(side("Bottom", "smallest"))
        .select(
            "Side",
            F.row_number().over(placed).alias("Rank"),
            composite_label(keys, null_text).alias("Label"),
            spec.total,
        )
    )
    within = [F.asc(spec.total), F.desc("Rank")] if ascending else [F.asc("Rank")]
    return ranked.orderBy(F.desc("Side"), *within)
