"""Totals of the reporting relation at the grain of a cube, kept up to date by batches of changes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions import col
from starfold.functions.measures import exact
from starfold.sources.mart import write_mart
from starfold.spec import SALES, CubeSpec

_ROWS, _PRESENT = "__rows", "__present"


class DeltaMart:
    """A cuboid under ``path`` that late and corrected sales do not rewrite.

    A batch adds rows, takes rows away, or both. Its signed totals per group are written to a folder
    of the batch's name, partitioned by year, in one committed write; a batch that is there is not
    written again, so a delivery that is repeated counts once. The cuboid is the sum of the batches.
    A failed attempt leaves no mark and is written over. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, spec: CubeSpec = SALES, partition: str = "SalesYear"):
        if partition not in spec.grain:
            raise ValueError(f"{partition} is not part of the grain")
        self.spark, self.path, self.spec, self.partition = spark, path.rstrip("/"), spec, partition

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _exists(self, path: str) -> bool:
        files, place = self._place(path)
        return files.exists(place)

    def _names(self, path: str, prefix: str) -> list[str]:
        files, place = self._place(path)
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        return sorted(n for n in names if n.startswith(prefix))

    def batches(self) -> list[str]:
        """Names of the committed batches, compactions among them."""
        folders = self._names(self.path, "batch=")
        return [f.removeprefix("batch=") for f in folders if self._exists(f"{self.path}/{f}/_SUCCESS")]

    def folders(self) -> list[str]:
        """The folders ``batch=.../SalesYear=...`` that the cuboid is read from: all of committed
        batches, without those a committed compaction stands for."""
        batches = self.batches()
        every = {
            f"batch={b}/{year}" for b in batches for year in self._names(f"{self.path}/batch={b}", f"{self.partition}=")
        }
        lists = [f"{self.path}/replaces={b}" for b in batches]
        lists = [path for path in lists if self._exists(f"{path}/_SUCCESS")]
        return sorted(every - ({r.value for r in self.spark.read.text(lists).collect()} if lists else set()))

    def _signed(self, df: DataFrame, sign: int) -> DataFrame:
        amount = exact(df, self.spec.measure, self.spec.float_as)
        return df.select(
            *[col(k) for k in self.spec.grain], (amount * sign).alias(self.spec.measure),
            F.lit(sign).alias(_ROWS), (col(self.spec.measure).isNotNull().cast("int") * sign).alias(_PRESENT),
        )

    def _summed(self, changes: DataFrame) -> DataFrame:
        """Signed totals per group. Groups that are empty again are left out."""
        measure = self.spec.measure
        sums = changes.groupBy(*[col(k) for k in self.spec.grain]).agg(
            F.coalesce(F.sum(col(measure)), F.lit(0)).alias(measure),
            F.sum(_ROWS).alias(_ROWS), F.sum(_PRESENT).alias(_PRESENT),
        )
        total = changes.schema[measure].dataType
        scale = total.scale if isinstance(total, T.DecimalType) else 0
        sums = sums.withColumn(measure, col(measure).cast(T.DecimalType(38, scale)))
        return sums.filter((F.col(_ROWS) != 0) | (F.col(_PRESENT) != 0) | (col(measure) != 0))

    def commit(self, batch: str, added: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """Add the rows of ``added`` and take those of ``removed`` away, under the name ``batch``;
        false if that batch was there. A floating point measure needs a decimal ``float_as``."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        given = [(df, sign) for df, sign in ((added, 1), (removed, -1)) if df is not None]
        if not given:
            raise ValueError("a batch adds or removes rows")
        for df, _ in given:
            if isinstance(df.schema[self.spec.measure].dataType, (T.FloatType, T.DoubleType)):
                if self.spec.float_as == "double":
                    raise ValueError(f"{self.spec.measure} is floating point: name a decimal in float_as")
        if self._exists(f"{self.path}/batch={batch}/_SUCCESS"):
            return False
        files, left = self._place(f"{self.path}/replaces={batch}")
        files.delete(left, True)  # of a compaction of that name which failed
        changes = [self._summed(self._signed(df, sign)) for df, sign in given]
        delta = changes[0] if len(changes) == 1 else self._summed(changes[0].unionByName(changes[1]))
        self._write(batch, delta)
        return True

    def _write(self, batch: str, delta: DataFrame) -> None:
        cluster = [k for k in self.spec.grain if k != self.partition]
        write_mart(delta, f"{self.path}/batch={batch}", self.partition, cluster)

    def _deltas(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]).select(*[col(f.name) for f in schema])

    def _stored(self, df: DataFrame) -> T.StructType:
        return self._summed(self._signed(df, 1)).schema

    def compact(self, batch: str, like: DataFrame) -> bool:
        """Sum the years that more than one batch holds into one folder each, committed as ``batch``;
        folders of other years stay the files they are. False if that batch was there. ``like``: a
        frame with the types of the sales. What it stands for is listed first and counts from the
        commit on, so the cuboid is the same before, between and after."""
        if self._exists(f"{self.path}/batch={batch}/_SUCCESS"):
            return False
        by_year: dict[str, list[str]] = {}
        for folder in self.folders():
            by_year.setdefault(folder.split("/")[1], []).append(folder)
        many = sorted(f for folders in by_year.values() if len(folders) > 1 for f in folders)
        schema = self._stored(like)
        listed = self.spark.createDataFrame([(f,) for f in many], "value string")
        listed.coalesce(1).write.mode("overwrite").text(f"{self.path}/replaces={batch}")
        self._write(batch, self._summed(self._deltas(many, schema)).select(*schema.names))
        return True

    def read(self, like: DataFrame) -> DataFrame:
        """The cuboid: every operator gives the same result on it as on all rows that were added and
        not removed. A filter on the year prunes folders. ``like``: as of :meth:`compact`."""
        sums = self._summed(self._deltas(self.folders(), self._stored(like)))
        amount = F.when(F.col(_PRESENT) > 0, col(self.spec.measure)).alias(self.spec.measure)
        return sums.filter(F.col(_ROWS) != 0).select(*[col(k) for k in self.spec.grain], amount)
