"""Declarative description of a cube: which columns are dimensions, measure and hierarchy.

Every operator takes a :class:`CubeSpec`, so the sales schema below is only the default.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Level:
    """One level of a hierarchy.

    ``label`` is a template over the hierarchy's columns, e.g. ``{SalesYear}-Q{SalesQuarter}``.
    """

    column: str
    name: str
    label: str


@dataclass(frozen=True)
class CubeSpec:
    """A measure that is summed, the dimensions it is cut by and one drill path.

    ``levels`` runs from the coarsest to the finest level. ``date`` names the column the top level
    is the calendar year of; year restrictions then also become a range on it, which a scan can
    use. Set it to ``None`` when the top level is not a year.

    Totals come out as ``total_type``. A double holds cents up to about 90 trillion; past that use
    a decimal, in which decimal amounts are summed anyway. A floating point measure is summed as
    ``float_as``: a double takes values of any size, its sums are exact and rounded once; a decimal
    is one column instead of bins, and refuses values that it cannot hold.
    """

    measure: str
    total: str
    dimensions: tuple[str, ...]
    levels: tuple[Level, ...]
    all_name: str = "All"
    scale: int = 2
    date: str | None = None
    total_type: str = "double"
    float_as: str = "double"

    @property
    def hierarchy(self) -> tuple[str, ...]:
        return tuple(level.column for level in self.levels)

    @property
    def grain(self) -> tuple[str, ...]:
        """Columns of the base cuboid: every dimension and every level."""
        return self.dimensions + self.hierarchy

    def level(self, name_or_column: str) -> Level:
        for level in self.levels:
            if name_or_column in (level.name, level.column):
                return level
        raise ValueError(f"unknown level {name_or_column!r}; known: {[lv.name for lv in self.levels]}")


# Column names, level names and label formats of the sales reporting relation.
SALES = CubeSpec(
    measure="SaleAmount",
    total="TotalSales",
    dimensions=("Region", "Category"),
    levels=(
        Level("SalesYear", "Year", "{SalesYear}"),
        Level("SalesQuarter", "Quarter", "{SalesYear}-Q{SalesQuarter}"),
        Level("YearMonth", "Month", "{YearMonth}"),
    ),
    all_name="All Years",
    date="SaleDate",
)
