"""Calendar parts of a sale date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_of(date: Column) -> Column:
    return F.year(date)


def quarter_of(date: Column) -> Column:
    return F.quarter(date)


def year_month(date: Column) -> Column:
    """``YYYY-MM`` text."""
    return F.date_format(date, "yyyy-MM")


def year_range(date: Column, first: int, last: int) -> Column:
    """``date`` lies in these years, in the half-open form that file statistics can answer."""
    return (date >= F.lit(dt.date(first, 1, 1))) & (date < F.lit(dt.date(last + 1, 1, 1)))
