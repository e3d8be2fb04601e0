"""A folder every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the session's own folder under ``spark.checkpoint.dir``, which goes with the
    session. Only a local session, which has one machine, may do without that setting; it uses the
    warehouse folder."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    own = f"{base.rstrip('/')}/starfold-{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{own}/{name}-{uuid.uuid4().hex}"
