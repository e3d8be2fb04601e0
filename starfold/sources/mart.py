"""The reporting relation, or a cuboid of it, as parquet partitioned by year."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions import col


def write_mart(
    df: DataFrame,
    path: str,
    partition: str = "SalesYear",
    cluster: Sequence[str] = ("Region", "Category"),
    mode: str = "overwrite",
    rebalance: bool = True,
) -> str:
    """Write partitioned by ``partition`` and sorted by ``cluster`` inside each file.

    The rebalance hint lets adaptive execution size the files: a year that holds much of the data
    is split over many tasks, small ones are merged, and each task writes to few folders. Sorting
    gives row groups narrow value ranges, so a slice skips most of a partition.

    ``rebalance=False`` is for a wide relation that joins have just dealt over even tasks: it is
    written by these, without one more shuffle of all its columns, and each task writes a file to
    every folder it has rows for.
    """
    (
        _clustered(df, partition, cluster, rebalance)
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy(partition)
        .parquet(path)
    )
    return path


def _clustered(df: DataFrame, partition: str, cluster: Sequence[str], rebalance: bool) -> DataFrame:
    dealt = df.hint("rebalance", col(partition)) if rebalance else df
    return dealt.sortWithinPartitions(*[col(c) for c in (partition, *cluster) if c in df.columns])


def read_mart(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The mart; give the schema to keep the column order and to skip reading a file footer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    frame = reader.parquet(path)
    return frame if schema is None else frame.select(*[col(f.name) for f in schema])


def latest_partition(
    spark: SparkSession, path: str, partition: str = "SalesYear", kind: str = "int"
) -> DataFrame:
    """One row with the latest member of the partition column of a mart, null if there is none.

    It is read from the names of the mart's folders, however many rows they hold; no file is opened.
    Rows without a member are in a folder of their own, which is passed over, and so are folders
    that hold no file.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f.getPath() for f in files.listStatus(place) if f.isDirectory()]
    named = {f.getName(): f for f in folders if f.getName().startswith(f"{partition}=")}
    texts = [(name, unquote(name.removeprefix(f"{partition}="))) for name in named]
    member = F.col("text").try_cast(kind)
    members = spark.createDataFrame(texts, "name string, text string").select("name", member.alias("member"))
    absent = F.col("name") != f"{partition}=__HIVE_DEFAULT_PARTITION__"
    for row in members.filter(absent & F.col("member").isNotNull()).orderBy(F.desc("member")).collect():
        if any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(named[row.name])):
            return spark.range(1).select(F.lit(row.member).cast(kind).alias("LatestMember"))
    return spark.range(1).select(F.lit(None).cast(kind).alias("LatestMember"))
