"""What the operators with keyed state have in common.

State lives in Spark's RocksDB store and is checkpointed with the stream, so a
lost executor or a restart goes on from the last batch.  Clocks are event time:
they move with the watermark and give the same rows in a replay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.shuffle import ExternalSorter
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Column that holds event time in microseconds since 1970, and the one with the watermark.
AT = "__at"
CLOCK = "__clock"
#: Memory of a Python worker, in MB, from which on the rows of a key and batch are sorted on disk.
SORT_MB = 512
#: Bytes of a partition that are packed at once, and rows of a key that a packed row holds at most.
PACK_BYTES = 64 << 20
PIECE_ROWS = 1 << 16


def use_state_store(spark: SparkSession) -> None:
    """Operators with timers and lists need the RocksDB store; another choice that was made stays."""
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKS)


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def from_micros(n: str | Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(n) if isinstance(n, str) else n, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def with_time(df: DataFrame, ts: str) -> DataFrame:
    """Rows that have a time, with it as ``AT``."""
    use_state_store(df.sparkSession)
    return df.where(F.col(ts).isNotNull()).withColumn(AT, micros(F.col(ts).cast("timestamp_ntz")))


def with_clock(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows that have a time, with it as ``AT`` and a watermark that follows ``delay`` behind."""
    return with_time(df, ts).withColumn(CLOCK, F.timestamp_micros(F.col(AT))).withWatermark(CLOCK, delay)


def milliseconds(at: int) -> int:
    """The first millisecond after a time in microseconds."""
    return at // 1000 + 1


def in_order(rows: Iterator[Row], order: Sequence[str], columns: Sequence[str], memory_mb: int = SORT_MB, at: str = AT) -> Iterator[tuple]:
    """``(time, *columns)`` of the rows of one key, by time and then ``order`` (nulls last), with bounded memory."""
    picked = (((row[at], *[(row[c] is None, row[c]) for c in order]), *[row[c] for c in columns]) for row in rows)
    for by, *values in ExternalSorter(memory_mb).sorted(picked, key=lambda r: r[0]):
        yield (by[0], *values)


class Packing:
    """Rows of a key and batch travel to Python as few rows with a list per column.

    Python reads the values of a list together; taking rows apart one by one costs
    it some ten times as much as the work on them.  A packed row is sorted by time
    and ``order``, and its clock is the time of its last row, so the watermark is
    that of the rows.  Spark leaves out packed rows that are late as a whole;
    ``unpacked`` leaves out single ones.
    """

    def __init__(self, by: Sequence[str], order: Sequence[str], columns: Sequence[str]):
        self._by, self._order, self._columns = tuple(by), tuple(order), tuple(columns)

    def pack(self, timed: DataFrame, delay: str, size: int = PACK_BYTES, piece: int = PIECE_ROWS) -> DataFrame:
        """``*by``, ``CLOCK`` with its watermark, and the lists of ``AT``, ``order`` and ``columns``."""
        fields = timed.schema
        values = [AT, *self._order, *self._columns]
        keys = [F.col(c).alias(f"__key{i}") for i, c in enumerate(self._by)]
        lists = [F.col(c).alias(f"__list{i}") for i, c in enumerate(values)]
        out = T.StructType([T.StructField(f"__key{i}", fields[c].dataType) for i, c in enumerate(self._by)])
        out = out.add(CLOCK, T.LongType())
        for i, c in enumerate(values):
            out = out.add(f"__list{i}", T.ArrayType(fields[c].dataType))
        together = timed.select(*keys, *lists).repartition(*[F.col(f"__key{i}") for i in range(len(keys))])
        packed = together.mapInArrow(_pack(len(keys), 1 + len(self._order), size, piece), out)
        named = [F.col(f"__key{i}").alias(c) for i, c in enumerate(self._by)]
        clock = F.timestamp_micros(CLOCK).alias(CLOCK)
        return packed.select(*named, clock, *[f"__list{i}" for i in range(len(values))]).withWatermark(CLOCK, delay)

    def unpacked(self, rows: Iterator[Row], watermark_ms: int) -> Iterator[tuple]:
        """``(time, *order, *columns)`` of the rows of one key in their order, without late ones."""
        at = len(self._by) + 1
        first, second = next(rows), next(rows, None)
        if second is None:
            ordered = zip(*first[at:])
        else:
            single = chain.from_iterable(zip(*row[at:]) for row in chain((first, second), rows))
            order = range(1, 1 + len(self._order))
            ordered = in_order(single, order, range(1, 1 + len(self._order) + len(self._columns)), at=0)
        late = watermark_ms * 1000
        return (row for row in ordered if row[0] > late)


def _pack(keys: int, order: int, size: int, piece: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pc.sort_indices(rows, [(c, "ascending") for c in rows.column_names[: keys + order]]))
        columns = [pa.concat_arrays(c.chunks) for c in rows.columns]
        n = rows.num_rows
        new = np.ones(n, bool)
        new[1:] = keys == 0
        for c in columns[:keys]:
            new[1:] |= pc.fill_null(pc.not_equal(c[1:], c[:-1]), True).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        cuts = [np.arange(starts[i], ends[i], piece) for i in np.flatnonzero(ends - starts > piece)]
        starts = np.unique(np.concatenate([starts, *cuts]))
        bounds = np.append(starts, n)
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), c) for c in columns[keys:]]
        return pa.RecordBatch.from_arrays(
            [*[c.take(pa.array(starts)) for c in columns[:keys]], columns[keys].take(pa.array(bounds[1:] - 1)), *lists],
            [*rows.column_names[:keys], CLOCK, *rows.column_names[keys:]],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_held = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                bytes_held += batch.nbytes
            if bytes_held >= size:
                yield packed(held)
                held, bytes_held = [], 0
        if held:
            yield packed(held)

    return pack
