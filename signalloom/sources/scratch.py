"""Intermediate tables in the folder the cluster shares between executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local folder only where it is unset
    and Spark runs on this machine alone."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="signalloom-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for every call."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on from the table: the lineage ends here, and a
    lost executor costs a re-read instead of the whole computation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
