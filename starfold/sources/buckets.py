"""Tables stored by their join key, so that joining them moves no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starfold.functions import col


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` as the catalog table ``table``, in ``buckets`` parts by ``key``, and
    return that table.

    Two tables with equal numbers of buckets join on the key without an exchange on either side, in
    every report that follows; the one shuffle is paid here. Each bucket is one file, sorted by the
    key, as rows are dealt by the key before they are written. A bucket is one task's work and cannot
    be split, so choose buckets of about 200 MB and a key with few rows each, such as an order's; a
    dimension key that may be hot is left to an adaptive join.
    """
    (
        df.repartition(buckets, col(key))
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
