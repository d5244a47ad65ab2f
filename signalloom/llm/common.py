"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, a null counted as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``column`` holds about ``limit`` characters at most.

    A slice has one row at least, so one very long text is a slice of its own.
    """
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        size = size or 0
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def release_memory() -> None:
    """Gives memory that a finished task no longer needs back to the machine; workers live on and would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


#: A table of so many longs marks hashes that are wanted, whatever their number.
BIT_WORDS = 1 << 18


def _placed(rows: DataFrame, mark: Column) -> DataFrame:
    """``rows`` with the place of a hash in a table of bits."""
    placed = rows.withColumn("__bit", F.pmod(mark, F.lit(64 * BIT_WORDS)))
    return placed.withColumn("__at", F.floor(F.col("__bit") / 64))


def _bits(wanted: DataFrame, by: Column) -> DataFrame:
    """The hashes ``by`` of all rows as bits of a table whose size does not depend on the data."""
    bit = F.pmod(by, F.lit(64 * BIT_WORDS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    return wanted.select(F.floor(bit / 64).alias("__at"), one.alias("__one")).groupBy("__at").agg(F.bit_or("__one").alias("__bits"))


def _there() -> Column:
    return F.call_function("getbit", F.col("__bits"), F.col("__bit") % 64) == 1


def marked(rows: DataFrame, mark: Column, wanted: DataFrame, by: Column) -> DataFrame:
    """Rows whose hash ``mark`` may be among the hashes ``by`` of ``wanted``: all that are, and few others.

    The table of bits is broadcast.  Beyond some millions of hashes it only lets
    more rows through.
    """
    return _placed(rows, mark).join(F.broadcast(_bits(wanted, by)), "__at").where(_there()).select(*rows.columns)


def with_mark(rows: DataFrame, mark: Column, wanted: DataFrame, by: Column, name: str) -> DataFrame:
    """All ``rows``, with a flag ``name`` on those that ``marked`` would let through."""
    found = _placed(rows, mark).join(F.broadcast(_bits(wanted, by)), "__at", "left")
    return found.select(*rows.columns, F.coalesce(_there(), F.lit(False)).alias(name))
