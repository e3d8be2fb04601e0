"""CSV: the sorted reporting extract, and reading text with explicit types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions import col
from starfold.schema import reporting_schema

# Texts that the usual data frame CSV readers take for a missing value.
MISSING_TEXTS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_SOURCE = "__source"
_TIE = "__tie"


# Quotes are doubled inside quotes, edge spaces stay, times keep their microseconds; multi-line
# values are read as such. Other tools read the same rows.
_SHAPE = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# An empty field is null and a quoted one the empty text; for that, the reader's mark of a null must
# be something that no text is. Fixed value: two noncharacters.
_NULL_READ = "\uffff\uffff"
_ROWS_PER_FILE = 1_000_000


def export_csv(
    df: DataFrame,
    path: str,
    order: Sequence[str] = ("SaleDate", "TransactionID"),
    mode: str = "overwrite",
    rows_per_file: int = _ROWS_PER_FILE,
    derived: Mapping[str, Column] | None = None,
) -> str:
    """Write a relation as CSV part files with a header, globally sorted.

    Part files hold consecutive ranges: reading them in name order gives the sorted rows. Ties are
    ordered by a hash of the other columns, so the order does not depend on where rows came from.
    The last range key is the number of the task a row came from: even rows that agree in every
    column spread over several files, and the number is the same when a lost task is run again.

    The range sort samples its input by computing it, so give it a stored relation, such as the
    mart. A file with values of several lines is read by one task; ``rows_per_file`` bounds it.

    The shuffle carries what it must: no hash, which is only a key, and none of ``derived``, columns
    that follow from others, by what they are made of; they are made again after it.
    """
    (
        _ordered(df, order, derived or {})
        .write.mode(mode)
        .options(**_SHAPE, maxRecordsPerFile=rows_per_file)
        .csv(path)
    )
    return path


def _ordered(df: DataFrame, order: Sequence[str], derived: Mapping[str, Column]) -> DataFrame:
    derived = {c: made for c, made in derived.items() if c not in order}
    carried = df.drop(*derived)
    rest = [c for c in carried.columns if c not in order]
    tie = F.xxhash64(*[col(c) for c in rest]) if rest else F.lit(0)
    keys = [col(c).asc_nulls_last() for c in order]
    return (
        carried.withColumn(_SOURCE, F.spark_partition_id())
        .repartitionByRange(*keys, tie, F.col(_SOURCE))
        .withColumn(_TIE, tie)
        .sortWithinPartitions(*keys, F.col(_TIE))
        .withColumns(derived)
        .select(*[col(c) for c in df.columns])
    )


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**_SHAPE).csv(path).columns


def _strict(spark: SparkSession, path: str, fields: Sequence[T.StructField]) -> DataFrame:
    """Columns by the names in the header of each file; one without such a header is an error."""
    reader = spark.read.options(**_SHAPE, nullValue=_NULL_READ, multiLine=True, enforceSchema=False, mode="FAILFAST")
    return reader.schema(T.StructType(list(fields))).csv(path)


def _named(header: Sequence[str], names: Sequence[str], path: str) -> None:
    missing = [n for n in names if n not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")


def read_reporting_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """The exported extract with its types; ``YearMonth`` stays text. Columns are found by name, in
    any order. A value that does not fit its type is an error."""
    schema = schema or reporting_schema()
    header = _header(spark, path)
    _named(header, schema.names, path)
    text = T.StringType()
    fields = [schema[n] if n in schema.names else T.StructField(n, text) for n in header]
    return _strict(spark, path, fields).select(*[col(n) for n in schema.names])


_WHOLE = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _present(spark: SparkSession, path: str, missing_texts: Sequence[str]) -> DataFrame:
    header = _header(spark, path)
    raw = _strict(spark, path, [T.StructField(n, T.StringType()) for n in header])
    return raw.select(*[F.when(~col(n).isin(list(missing_texts)), col(n)).alias(n) for n in header])


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    missing_texts: Sequence[str] = MISSING_TEXTS,
) -> DataFrame:
    """Any CSV with a header, for profiling: the given texts become null before typing, a value
    that does not fit its type becomes null; :func:`failed_values` counts these.

    The columns of a schema are found by name. Without a schema one pass over the file types each
    column: whole numbers, numbers, true and false, or else text. Whole numbers of any length stay
    exact: past 64 bits they are decimals, past 38 digits text. Dates stay text, and so does
    ``2025-05``.
    """
    present = _present(spark, path, missing_texts)
    schema = _typed(present) if schema is None else _schema(schema)
    _named(present.columns, schema.names, path)
    return present.select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def failed_values(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    missing_texts: Sequence[str] = MISSING_TEXTS,
) -> DataFrame:
    """``column, failed``: how many present values of each column do not fit its type."""
    present, schema = _present(spark, path, missing_texts), _schema(schema)
    _named(present.columns, schema.names, path)
    failed = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count_if(col(f.name).isNotNull() & col(f.name).try_cast(f.dataType).isNull()).alias("failed"),
        )
        for f in schema
    ]
    return present.agg(F.array(*failed).alias("c")).select(F.explode("c").alias("c")).select("c.*")


_CORRUPT = "__corrupt"


def sort_out_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    missing_texts: Sequence[str] = MISSING_TEXTS,
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit ``schema``, typed, and those that do not, as data, so that one bad value does
    not end a load. Every row is in one of the two.

    Rejected rows: ``file``, ``record`` (the text of a row with another number of fields than the
    header, else null), ``fields`` (texts by column) and ``failed``, an array of ``column, value`` of the
    present values that do not fit. Columns are found by name; a file with another header than the
    first one is an error. Both frames are lazy and read the files for themselves.
    """
    schema, header = _schema(schema), _header(spark, path)
    _named(header, schema.names, path)
    texts = [T.StructField(n, T.StringType()) for n in [*header, _CORRUPT]]
    raw = (
        spark.read.options(**_SHAPE, nullValue=_NULL_READ, multiLine=True, enforceSchema=False)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, columnPruning=False)
        .schema(T.StructType(texts)).csv(path)
    )
    # Spark refuses to read the text of bad rows alone; this is true of every row and reads a column
    read = F.length(F.concat_ws("", col(header[0]))) >= 0
    raw = raw.withColumn(_CORRUPT, F.when(read, F.col(_CORRUPT)))
    shown = {n: F.when(~col(n).isin(list(missing_texts)), col(n)) for n in header}
    failed = [
        F.when(
            shown[f.name].isNotNull() & shown[f.name].try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column"), shown[f.name].alias("value")),
        )
        for f in schema
    ]
    marked = raw.withColumn("__failed", F.array_compact(F.array(*failed)))
    fits = F.col(_CORRUPT).isNull() & (F.size("__failed") == 0)
    good = marked.filter(fits).select(*[shown[f.name].try_cast(f.dataType).alias(f.name) for f in schema])
    fields = F.create_map(*[x for n in header for x in (F.lit(n), col(n))])
    rejected = marked.filter(~fits).select(
        F.col("_metadata.file_name").alias("file"), F.col(_CORRUPT).alias("record"),
        fields.alias("fields"), F.col("__failed").alias("failed"),
    )
    return good, rejected


def _typed(text: DataFrame) -> T.StructType:
    """The narrowest type that every present value of a column fits; no value at all is a double,
    as in a data frame. A column of whole numbers is never a double, which would round them."""
    long, decimal = T.LongType(), T.DecimalType(38, 0)
    candidates = [
        (long, lambda c: c.rlike(_WHOLE) & c.try_cast(long).isNotNull()),
        (decimal, lambda c: c.rlike(_WHOLE) & c.try_cast(decimal).isNotNull()),
        (T.StringType(), lambda c: c.rlike(_WHOLE)),
        (T.DoubleType(), lambda c: c.rlike(_NUMBER)),
        (T.BooleanType(), lambda c: F.lower(c).isin("true", "false")),
    ]
    fits = text.agg(
        *[
            F.coalesce(F.every(F.when(col(n).isNotNull(), test(col(n)))), F.lit(True)).alias(f"{i}_{j}")
            for i, n in enumerate(text.columns)
            for j, (_, test) in enumerate(candidates)
        ],
        *[F.count(col(n)).alias(f"{i}_n") for i, n in enumerate(text.columns)],
    ).first()
    fields = []
    for i, name in enumerate(text.columns):
        matching = [t for j, (t, _) in enumerate(candidates) if fits[f"{i}_{j}"]]
        none = T.DoubleType() if fits[f"{i}_n"] == 0 else None
        fields.append(T.StructField(name, none or (matching or [T.StringType()])[0]))
    return T.StructType(fields)
