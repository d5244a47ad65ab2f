"""Session settings the operators are written for.

On a cluster these belong in the submit configuration; ``build`` is for tests,
the benchmark and notebooks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str = "local[*]", app: str = "signalloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
