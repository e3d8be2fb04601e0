"""Session settings the reports rely on. Applications apply them; operators never touch a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS: dict[str, str] = {
    # Calendar parts of timestamps must not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Split a join partition that a hot key fills, also where totals per join key follow and the
    # split costs them a shuffle of their partial sums: without it the hot key is one task's work.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
