"""Backup policies and backup state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.schemas import BACKUP_POLICY, BACKUP_STATE_FIELDS


def read_backup_policy(spark: SparkSession, path: str) -> DataFrame:
    """The newest policy of each project, in the columns of ``backup_due``."""
    raw = spark.read.schema(BACKUP_POLICY).json(path).filter(F.col("project_id").isNotNull())
    newest = raw.groupBy("project_id").agg(F.max_by(F.struct(*raw.columns), "fetchedAt").alias("p"))
    return newest.select(
        "project_id",
        F.col("p.enabled").alias("enabled"),
        F.col("p.intervalHours").alias("interval_hours"),
        F.col("p.preferredHourUtc").alias("preferred_hour_utc"),
        F.col("p.maxSizeMb").alias("max_size_mb"),
        F.col("p.runNowRequestedAt").alias("run_now_at"),
        F.col("p.encryptionKeyFingerprint").alias("expected_fingerprint"),
    )


def _only_text(value: Column, name: str) -> Column:
    """The member if it is JSON text; numbers, booleans and objects become null."""
    member = F.try_variant_get(value, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(member) == "STRING", F.try_variant_get(value, f"$.{name}", "string"))


def read_backup_state(spark: SparkSession, path: str) -> DataFrame:
    """State files ``{project_id, ...}`` in the columns of ``backup_due``; unknown
    members are dropped and any of the three that is not a string becomes null."""
    parsed = spark.read.text(path).select(F.try_parse_json("value").alias("v"))
    return parsed.select(
        F.try_variant_get("v", "$.project_id", "string").alias("project_id"),
        *[_only_text(F.col("v"), n).alias(c) for n, c in BACKUP_STATE_FIELDS.items()],
    ).filter(F.col("project_id").isNotNull())


def upsert_backup_state(state: DataFrame, patch: DataFrame, key: str = "project_id") -> DataFrame:
    """Fields given by the patch replace the old ones, the rest stays.

    A null in the patch is "not given"; projects that are new are added.  A
    column that the state does not have is an error.
    """
    if unknown := set(patch.columns) - set(state.columns):
        raise ValueError(f"the state has no {sorted(unknown)}")
    fields = [c for c in state.columns if c != key]
    side = patch.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__p_{c}") for c in fields if c in patch.columns])
    joined = state.join(side, F.col(key) == F.col("__key"), "full")
    return joined.select(
        F.coalesce(key, "__key").alias(key),
        *[
            (F.coalesce(f"__p_{c}", c) if c in patch.columns else F.col(c)).alias(c)
            for c in fields
        ],
    )
