"""Column expressions shared by the operators; all of them are built-in JVM expressions."""

from starfold.functions.columns import col, composite_label, currency, level_label
from starfold.functions.measures import exact, rounded, summed
from starfold.functions.periods import quarter_of, year_month, year_of, year_range

__all__ = [
    "col", "composite_label", "currency", "exact", "level_label", "quarter_of", "rounded",
    "summed", "year_month", "year_of", "year_range",
]
