"""The measure: exact sums, rounded at the end.

Amounts are added as decimals. A decimal sum does not depend on the order of the rows, so partial
sums over any partitioning, and sums of pre-aggregated sums, give the same total to the cent. A
floating point measure is added up exactly in bins (see ``exact_floats``), so that values of any size
count, or as a decimal that the caller names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions.columns import col


def exact(df: DataFrame, measure: str, float_as: str = "double") -> Column:
    """The measure as it is added up; NaN counts as missing. ``float_as`` is the type of a floating
    point measure. A value that it cannot hold is an error, whatever the session's ANSI setting."""
    c = col(measure)
    if not isinstance(df.schema[measure].dataType, (T.FloatType, T.DoubleType)):
        return c
    present = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    if float_as == "double":
        return present
    fitted = present.try_cast(float_as)
    refusal = F.raise_error(F.concat(F.lit(f"{measure} does not fit {float_as}: "), present.cast("string")))
    return F.when(present.isNotNull() & fitted.isNull(), refusal.cast(float_as)).otherwise(fitted)


def summed(df: DataFrame, measure: str, float_as: str = "double") -> Column:
    return F.sum(exact(df, measure, float_as))


def rounded(total: Column, scale: int = 2, as_type: str = "double") -> Column:
    """Round a sum, and leave the decimal domain if ``as_type`` is a double."""
    return F.round(total, scale).cast(as_type)
