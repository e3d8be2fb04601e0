"""The star schema as parquet folders or catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from starfold.operators.checks import require_columns
from starfold.schema import WAREHOUSE_TABLES


def _fail(missing: Sequence[str]) -> None:
    if missing:
        raise RuntimeError(f"no such tables in the warehouse: {', '.join(sorted(missing))}")


def require_tables(
    spark: SparkSession, names: Sequence[str] = tuple(WAREHOUSE_TABLES), database: str | None = None
) -> None:
    """Check that catalog tables or views exist; the error lists all that do not, sorted."""
    prefix = f"{database}." if database else ""
    _fail([n for n in names if not spark.catalog.tableExists(prefix + n)])


def open_warehouse(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, Sequence[str]] = WAREHOUSE_TABLES,
    suffix: str = "",
) -> dict[str, DataFrame]:
    """Tables stored as ``path/name`` + ``suffix`` in parquet. A missing path is an error, never an
    empty warehouse; so is a missing column."""
    frames: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name in tables:
        try:
            frames[name] = spark.read.parquet(f"{path.rstrip('/')}/{name}{suffix}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    _fail(missing)
    for name, columns in tables.items():
        require_columns(frames[name], columns, name)
    return frames
