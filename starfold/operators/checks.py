"""Guards around the star join and around empty results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starfold.functions import col


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise if the frame is empty. Runs a job that stops at the first row, so give it restricted
    detail rather than an aggregate."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_columns(df: DataFrame, names, what: str = "relation") -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {', '.join(missing)}")
    return df


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def observed_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame, and a row count that is filled in by whatever action runs on it first."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def orphan_rows(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows that the inner join leaves out: key unknown to the dimension, or null. Rows with a
    null key go round the join, as it would gather them all in one partition."""
    known = fact.filter(col(key).isNotNull()).join(dimension.select(key), key, "left_anti")
    return known.unionByName(fact.filter(col(key).isNull()).select(known.columns))


def orphan_facts(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension key: how many keys, and how many fact rows, have no dimension row: those that
    :func:`orphan_rows` lists, as keys keep their types and are compared in the same way.

    One pass over the facts counts the rows of every key of every dimension; only these counts meet
    the dimensions, in one join, so a key that holds much of the fact crosses the network once per
    task. A null key is an orphan like any unknown one, and is one row by then.
    """

    def keyed(frame: DataFrame, own: str) -> list[Column]:
        """The position of a key, and a column for each key, null for all but ``own``."""
        columns = []
        for i, (key, dimension) in enumerate(dimensions.items()):
            kind = (dimension if frame is not fact else fact).schema[key].dataType
            columns.append((col(key) if key == own else F.lit(None).cast(kind)).alias(f"key{i}"))
        return [F.lit(list(dimensions).index(own)).alias("position"), *columns]

    keys = F.array(*[F.struct(*keyed(fact, key)) for key in dimensions])
    counts = (
        fact.select(F.explode(keys).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
        .select("k.*", "rows")
    )
    known = [
        dimension.where(col(key).isNotNull()).select(*keyed(dimension, key))
        for key, dimension in dimensions.items()
    ]
    known = reduce(DataFrame.unionByName, known)
    # the columns of the other keys are null on both sides, so that all of them can be join keys
    same = [counts["position"] == known["position"]]
    same += [counts[f"key{i}"].eqNullSafe(known[f"key{i}"]) for i in range(len(dimensions))]
    orphans = counts.join(known, reduce(and_, same), "left_anti")
    names = F.posexplode(F.array(*[F.lit(key) for key in dimensions]))
    every = fact.sparkSession.range(1).select(names.alias("position", "dimension_key"))
    found = orphans.groupBy("position").agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("rows").alias("orphan_rows")
    )
    return every.join(found, "position", "left").orderBy("position").select(
        "dimension_key",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("orphan_keys", "orphan_rows")],
    )


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Dimension keys that occur more than once and would multiply fact rows."""
    return (
        dimension.groupBy(col(key))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
        .orderBy(col(key))
    )
