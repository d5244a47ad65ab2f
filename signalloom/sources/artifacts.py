"""Snapshots on storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.operators.snapshots import (
    CHUNK_BYTES,
    SnapshotError,
    artifact_size_gate,
    build_artifacts,
    fingerprint,
    manifest_of,
)


def write_encrypted_snapshot(
    df: DataFrame,
    path: str,
    key_hex: str,
    max_mb: int,
    snapshot_id: str,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Write artifacts, then their manifest, then the run; returns the run row.

    The manifest is made from what was written, because sealing again would
    give other bytes.  A snapshot over the limit has a FAILED run, and
    ``read_snapshot`` refuses it; nothing is ever cut off.
    """
    spark = df.sparkSession
    fingerprint(key_hex)  # refuse before any work
    base = f"{path}/{snapshot_id}"
    build_artifacts(df, key_hex, snapshot_id, chunk_bytes).write.parquet(f"{base}/artifacts")
    manifest_of(spark.read.parquet(f"{base}/artifacts")).write.parquet(f"{base}/manifest")
    taken = spark.createDataFrame([(snapshot_id,)], "snapshot_id string")
    artifact_size_gate(spark.read.parquet(f"{base}/manifest"), max_mb, taken).write.parquet(f"{base}/run")
    return spark.read.parquet(f"{base}/run")


def read_snapshot(spark: SparkSession, path: str, snapshot_id: str) -> tuple[DataFrame, DataFrame]:
    """(artifacts, manifest) of a snapshot whose run succeeded."""
    base = f"{path}/{snapshot_id}"
    bad = spark.read.parquet(f"{base}/run").filter(F.col("run_status") != "UPLOADED").select("error").first()
    if bad is not None:
        raise SnapshotError(bad["error"])
    return spark.read.parquet(f"{base}/artifacts"), spark.read.parquet(f"{base}/manifest")


_OWN_FOLDER = r"/chunk_id=([^/]+)/[^/]+\z"


def write_artifact_files(artifacts: DataFrame, path: str) -> None:
    """One file per artifact under ``path``, in a folder ``chunk_id=<name>``.

    Spark's text writer puts the bytes there as they are, and a line break after
    them, so any store that Spark reaches will do.
    """
    artifacts.select("chunk_id", F.col("artifact").cast("string").alias("value")).write.partitionBy("chunk_id").text(path)


def read_artifacts(spark: SparkSession, path: str, snapshot_id: str = "files") -> DataFrame:
    """Artifacts that lie as single files, ``chunk_id`` being the file name.

    In folders of ``write_artifact_files`` it is the folder's, and the line break is left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    own = F.regexp_extract("path", _OWN_FOLDER, 1)
    return files.select(
        F.lit(snapshot_id).alias("snapshot_id"),
        F.when(own != "", own).otherwise(F.regexp_extract("path", r"([^/]+)\z", 1)).alias("chunk_id"),
        F.when(own != "", F.substring("content", F.lit(1), F.octet_length("content") - 1)).otherwise(F.col("content")).alias("artifact"),
    )
