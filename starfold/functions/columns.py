"""Column access and text labels."""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "(null)"


def col(name: str) -> Column:
    """Column by its literal name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def composite_label(keys: Sequence[str], null_text: str | None = NULL_TEXT) -> Column:
    """``East / Office``. A null key shows as ``null_text``; pass ``None`` to leave it out."""
    parts = [col(k).cast("string") for k in keys]
    if null_text is not None:
        parts = [F.coalesce(p, F.lit(null_text)) for p in parts]
    return parts[0] if len(parts) == 1 else F.concat_ws(" / ", *parts)


def level_label(template: str) -> Column:
    """Fill a template such as ``{SalesYear}-Q{SalesQuarter}``; null if any part is null."""
    parts: list[Column] = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field is not None:
            parts.append(col(field).cast("string"))
    return F.concat(*parts)


def currency(amount: Column) -> Column:
    """``$1,234.56``."""
    return F.concat(F.lit("$"), F.format_number(amount, 2))
