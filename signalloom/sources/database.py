"""Tables of a PostgreSQL database."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession


def jdbc_target(url: str) -> tuple[str, dict[str, str]]:
    """A connection URL as (JDBC URL, properties).

    User and password travel as properties: URLs end up in plans, logs and the UI.
    """
    u = urlsplit(url)
    if u.scheme not in ("postgres", "postgresql") or not u.hostname:
        raise ValueError("not a PostgreSQL connection URL")
    target = f"jdbc:postgresql://{unquote(u.hostname)}"
    if u.port:
        target += f":{u.port}"
    database = unquote(u.path.lstrip("/"))
    target += f"/{database}" if database else "/"
    properties = {"driver": "org.postgresql.Driver"}
    if u.username:
        properties["user"] = unquote(u.username)
    if u.password:
        properties["password"] = unquote(u.password)
    sslmode = parse_qs(u.query).get("sslmode")
    if sslmode:
        properties["sslmode"] = sslmode[0]
    return target, properties


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One table, read by ``partitions`` parallel range scans over ``column``.

    Rows outside ``bounds`` are read too: bounds only place the cuts.
    """
    target, properties = jdbc_target(url)
    properties = {"fetchsize": "10000", **properties, **(options or {})}
    if column is None:
        return spark.read.jdbc(target, table, properties=properties)
    if bounds is None:
        raise ValueError("a partition column needs bounds")
    return spark.read.jdbc(
        target,
        table,
        column=column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )
