"""Operator 1: token files of directly addressable codes.

An id is cut into chunks, low bits first.  Level 1 holds the first chunk of
every token, level 2 the second chunk of those tokens that need one, and so on.
A bitmap beside each level says which tokens continue, and a rank directory
counts its set bits per block, so token ``i`` is found by one short read per
level; nothing is decoded around it.

A shard is one self-contained byte string (``DacShard`` opens it).  Shards are
rows of a Parquet table, because only Spark's writers reach every store and
commit the output of each task once, also when tasks are repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from signalloom.llm.common import small_batches, whole_text
from signalloom.llm.encoding import default_vocabulary, with_end, word_cache

MAGIC = b"DACS0001"
WIDTHS = (12, 4, 16)
RANK_BITS = 512
SHARD_TOKENS = 1 << 18
END_ID = 2

SHARD_SCHEMA = "part int, part_tokens long, n_docs long, n_tokens long, data binary"


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.reshape(-1), bitorder="little")


def _unpack(data: np.ndarray, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width)
    out = np.zeros(n, np.uint32)
    for k in range(width):
        out |= bits[:, k].astype(np.uint32) << np.uint32(k)
    return out


def encode_shard(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """A shard of ``ids`` (unsigned 32 bit) of documents with these lengths."""
    values, levels = ids.astype(np.uint32), []
    for k, width in enumerate(widths):
        low = values & np.uint32((1 << width) - 1) if width < 32 else values
        rest = values >> np.uint32(width) if width < 32 else np.zeros_like(values)
        more = rest > 0 if k + 1 < len(widths) else np.zeros(len(values), bool)
        if k + 1 == len(widths) and rest.any():
            raise ValueError("an id has more bits than the chunk widths hold")
        padded = np.pad(more, (0, -len(more) % RANK_BITS))
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, RANK_BITS).sum(axis=1))]).astype("<u4")
        levels.append((len(values), _pack(low, width), np.packbits(more, bitorder="little"), ranks))
        values = rest[more]
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [np.array([d or 0 for d in doc_ids], "<i8"), known, np.asarray(lengths, "<i8")]
    head = [len(ids), len(doc_ids), len(widths)]
    for width, (n, chunks, more, ranks) in zip(widths, levels, strict=True):
        head += [width, n, chunks.nbytes, more.nbytes, ranks.nbytes]
        parts += [chunks, more, ranks]
    return MAGIC + np.array(head, "<i8").tobytes() + b"".join(p.tobytes() for p in parts)


class DacShard:
    """A shard opened for reading; ``token`` and ``document`` read only what they need."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a shard of directly addressable codes")
        self.n_tokens, self.n_docs, n_levels = (int(x) for x in np.frombuffer(data, "<i8", 3, 8))
        head = np.frombuffer(data, "<i8", 5 * n_levels, 32).reshape(n_levels, 5)
        at = 32 + 40 * n_levels
        ids = np.frombuffer(data, "<i8", self.n_docs, at)
        known = np.frombuffer(data, np.uint8, self.n_docs, at + 8 * self.n_docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        at += 9 * self.n_docs
        self.lengths = np.frombuffer(data, "<i8", self.n_docs, at)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        at += 8 * self.n_docs
        self.levels = []
        for width, n, *sizes in head.tolist():
            views = []
            for size, kind in zip(sizes, (np.uint8, np.uint8, "<u4"), strict=True):
                views.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append((width, n, *views))

    def token(self, i: int) -> int:
        """The id at place ``i`` of the shard."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for width, _, chunks, more, ranks in self.levels:
            first, last = i * width, (i + 1) * width
            window = int.from_bytes(chunks[first // 8 : -(-last // 8)].tobytes(), "little")
            value |= (window >> first % 8 & (1 << width) - 1) << shift
            shift += width
            if not more[i // 8] >> i % 8 & 1:
                break
            block = i // RANK_BITS
            before = np.unpackbits(more[block * RANK_BITS // 8 : i // 8 + 1], bitorder="little")
            i = int(ranks[block]) + int(before[: i - block * RANK_BITS].sum())
        return value

    def document(self, k: int) -> np.ndarray:
        """All ids of the ``k``-th document of the shard."""
        return np.array([self.token(i) for i in range(self.starts[k], self.starts[k + 1])], np.uint32)

    def tokens(self) -> np.ndarray:
        """All ids of the shard, decoded level by level from the last."""
        above = np.empty(0, np.uint32)
        for width, n, chunks, more, _ in reversed(self.levels):
            values = _unpack(chunks, width, n)
            if len(above):
                values[np.unpackbits(more, count=n, bitorder="little").astype(bool)] |= above << np.uint32(width)
            above = values
        return above


def write_shards(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    widths: tuple[int, ...] = WIDTHS,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``docs`` (doc_id, text) and write shards in ascending doc_id order.

    A null text is empty and still gets its end id; a null doc_id comes first.
    Rows with the same doc_id stay side by side, ordered by a hash of the text,
    which also lets a very frequent doc_id span partitions.  An empty table
    gives an empty shard table.  Other columns are ignored.
    """
    vocabulary = vocabulary or default_vocabulary()
    kinds = T.StructType.fromDDL(SHARD_SCHEMA)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        ids, lengths, names, held = [], [], [], 0

        def sealed() -> pa.RecordBatch:
            flat, sizes = np.concatenate(ids), np.concatenate(lengths)
            data = encode_shard(flat, names, sizes, widths)
            row = {"part": part, "part_tokens": before, "n_docs": len(names), "n_tokens": len(flat), "data": data}
            return pa.RecordBatch.from_pylist([row], to_arrow_schema(kinds))

        for whole in batches:
            for batch in small_batches(whole, "text", shard_tokens):
                flat, sizes = with_end(*word_cache(vocabulary).encode(batch.column("text").to_pylist()), end_id)
                ids.append(flat)
                lengths.append(sizes)
                names += batch.column("doc_id").to_pylist()
                held += len(flat)
                if held >= shard_tokens:
                    yield sealed()
                    before += held
                    ids, lengths, names, held = [], [], [], 0
        if names:
            yield sealed()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    ordered.select("doc_id", "text").mapInArrow(encode, SHARD_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the shards: doc_id, start, n_tokens, ids_crc32.

    A shard knows how many tokens of its part came before it; what came
    before the part is a running sum over one row per writing task, few enough
    to be broadcast.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_start"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("data").to_pylist(), strict=True):
                shard = DacShard(data)
                ids = shard.tokens().astype("<u4")
                view, edges = memoryview(ids.tobytes()), 4 * shard.starts
                crc = [zlib.crc32(view[edges[k] : edges[k + 1]]) for k in range(shard.n_docs)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "start": pa.array(base + shard.starts[:-1], pa.int64()),
                        "n_tokens": pa.array(shard.lengths, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    return (
        shards.join(F.broadcast(parts), "part")
        .select((F.col("part_start") + F.col("part_tokens")).alias("base"), "data")
        .mapInArrow(digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
