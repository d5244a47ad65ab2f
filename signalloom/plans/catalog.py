"""All registered queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalloom.plans import (
    backup_queries,
    delivery_queries,
    event_queries,
    firewall_queries,
    io_queries,
    redact_queries,
)
from signalloom.plans.views import with_views

MODULES = (firewall_queries, redact_queries, event_queries, delivery_queries, backup_queries, io_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for m in MODULES for name, sql in m.ORACLE.items()}
