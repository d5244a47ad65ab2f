"""Deciding whether a table is small enough to be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Tables from this size on have their rows counted, and rows that a task may get of them.
COUNTED_BYTES = 4 << 20
TASK_ROWS = 200_000


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """True only if ``df`` is known to stay under both bounds."""
    return values_if_small(df, F.lit(0), max_rows, max_bytes) is not None


def values_if_small(
    df: DataFrame,
    value: Column,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> set | None:
    """The distinct values of ``value`` in a table that fits both bounds, else None.

    The check fetches one small number per row and stops after ``max_rows + 1``
    rows: Spark runs the last stage on one partition, then on a few more, only
    until the limit is reached, so a table that does not fit costs little.  The
    byte count is that of the rows as text.
    """
    if max_rows <= 0:
        return None
    size = F.octet_length(F.to_json(F.struct(F.struct(*df.columns).alias("r"))))
    rows = df.select(size.alias("size"), value.alias("value")).limit(max_rows + 1).collect()
    if len(rows) > max_rows or sum(r["size"] for r in rows) > max_bytes:
        return None
    return {r["value"] for r in rows}


def maybe_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it fits; else as it is, for a shuffle join
    that adaptive execution may still split where a key is hot."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def row_hash(df: DataFrame) -> Column:
    """A number that depends on the row only, so a recomputed task gives it again."""
    plain = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def row_salt(df: DataFrame, n: int) -> Column:
    """``row_hash`` as a number in 0..n-1."""
    return F.pmod(row_hash(df), F.lit(n)).cast("int")


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_holds_map(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _holds_map(t.elementType)
    return isinstance(t, (T.MapType, T.VariantType))


def spread(df: DataFrame, min_bytes: int = 1 << 20, max_rows: int | None = None) -> DataFrame:
    """Give CPU-heavy work on a few unsplittable files more tasks than files.

    A scan that already has a partition per core passes unchanged.  With
    ``max_rows`` tasks of a larger table get no more rows than about that: Spark
    cuts files by bytes but reads row groups whole, so that compressed rows can
    lie by the million in a few tasks.  Rows are counted without reading a column.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution()
    size = int(str(plan.optimizedPlan().stats().sizeInBytes()))
    few = plan.toRdd().getNumPartitions() < cores
    if max_rows is not None and size >= COUNTED_BYTES:
        held = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
        rows = held.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
        if (rows["most"] or 0) > max_rows:
            return df.repartition(max(cores, -(-rows["all"] // max_rows)))
    return df.repartition(cores) if few and size >= min_bytes else df
