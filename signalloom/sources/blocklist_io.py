"""Versions of a blocklist on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.operators.blocklist import parse_expiry
from signalloom.schemas import BLOCKLIST_SNAPSHOT


def read_blocklist_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All usable versions; those without a mode or with no entry array are ignored.

    Gives ``fetched_at, mode, entries`` as ``match_point_in_time`` takes them.
    """
    raw = spark.read.schema(BLOCKLIST_SNAPSHOT).json(path)
    usable = raw.filter((F.col("mode") != "") & F.col("entries").isNotNull())
    entries = F.transform(
        "entries",
        lambda e: F.struct(
            e["type"].alias("type"), e["value"].alias("value"), parse_expiry(e["expiresAt"]).alias("expires_at")
        ),
    )
    at = F.timestamp_millis("fetchedAt").cast("timestamp_ntz")
    return usable.select(at.alias("fetched_at"), "mode", entries.alias("entries"))


def append_blocklist_snapshot(snapshots: DataFrame, path: str) -> None:
    """Add versions ``fetchedAt, mode, entries``; readers take the newest valid one."""
    snapshots.select("mode", "entries", "fetchedAt").write.mode("append").json(path)


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The version a cold start would load."""
    return snapshots.agg(F.max_by(F.struct(*snapshots.columns), "fetched_at").alias("s")).select("s.*")
