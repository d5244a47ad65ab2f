"""A durable copy of the queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from signalloom.limits import SPOOL_TTL_HOURS
from signalloom.operators.delivery import drop_expired, persist_budget
from signalloom.operators.nested import scrub_json
from signalloom.sources.scratch import materialize


def spool_rows(
    df: DataFrame,
    by: str | Sequence[str] | None,
    item: str = "item_json",
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """What may be stored: redacted items within the item and total limits."""
    clean = materialize(df.withColumn(item, scrub_json(item)), "spool")
    return persist_budget(clean, item, by, order)


def write_spool(
    df: DataFrame,
    path: str,
    by: str | Sequence[str] | None,
    item: str = "item_json",
    order: Sequence[str] = ("ts", "event_id"),
) -> None:
    """Replace the stored copy of the queue."""
    spool_rows(df, by, item, order).write.mode("overwrite").parquet(path)


def read_spool(
    spark: SparkSession, path: str, now: Column, created: str = "ts", ttl_hours: int = SPOOL_TTL_HOURS
) -> DataFrame:
    """The stored items that have not expired; the limit is pushed into the scan."""
    return drop_expired(spark.read.parquet(path), now, ttl_hours, created)
