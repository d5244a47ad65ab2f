"""Operator 9: quartile digests of byte triplets.

Every three consecutive bytes are hashed into one of ``BUCKETS`` counters.  A
counter is written as 0 to 3, the quarter of all counters it lies in, so the
digest keeps the shape of the counts and not their size; the length goes before
it as a logarithmic code.  Two digests differ by the distance of their
quarters (opposite quarters count double) and of their length codes, cut at a
bound; likeness is 1 at no difference and 0 at the bound.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalloom.llm.common import shuffle_partitions, small_batches, whole_text

BUCKETS = 512
#: Differences from here on are as bad as any: a bit more than unrelated texts of one language have.
BOUND = 900
#: Of two length codes, and the most they add.
LENGTH_STEP, LENGTH_MOST = 8, 160
_MIX = np.uint32(0x9E3779B1)
_NIBBLES = np.array(list("0123456789abcdef"))


def length_code(n: int) -> int:
    """Lengths that differ by a tenth have codes about one apart; 0 to 255."""
    return min(255, round(math.log(n + 1) / math.log(1.1)))


def quarters(data: bytes) -> np.ndarray:
    """0 to 3 for each bucket."""
    if len(data) < 3:
        return np.zeros(BUCKETS, np.uint8)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    triplets = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    slots = triplets * _MIX >> np.uint32(32 - BUCKETS.bit_length() + 1)
    counts = np.bincount(slots, minlength=BUCKETS)
    ordered = np.sort(counts)
    cuts = ordered[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    return (counts[:, None] > cuts).sum(axis=1).astype(np.uint8)


def to_text(code: int, quarter: np.ndarray) -> str:
    nibbles = quarter[0::2] << 2 | quarter[1::2]
    return f"{code:02x}" + "".join(_NIBBLES[nibbles])


def from_text(digest: str) -> tuple[int, np.ndarray]:
    nibbles = np.frombuffer(bytes.fromhex(digest[2:]), np.uint8)
    nibbles = np.stack([nibbles >> 4, nibbles & 15], axis=1).reshape(-1)
    return int(digest[:2], 16), np.stack([nibbles >> 2, nibbles & 3], axis=1).reshape(-1).astype(np.uint8)


def fingerprint(text: str) -> str:
    data = text.encode()
    return to_text(length_code(len(data)), quarters(data))


def difference(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> int:
    apart = np.abs(a[1].astype(np.int16) - b[1].astype(np.int16))
    shape = int(apart.sum()) + 3 * int((apart == 3).sum())
    return min(BOUND, shape + min(LENGTH_MOST, LENGTH_STEP * abs(a[0] - b[0])))


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for a difference at the bound."""
    return 1.0 - difference(from_text(a), from_text(b)) / BOUND


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the digest of every whole text; a null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "text"):
                digests = [fingerprint(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fingerprint": pa.array(digests, pa.string())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def _with_follower(docs: DataFrame, partitions: int) -> DataFrame:
    """Rows (part, text ...) where each part, in order, is closed by the head of the next.

    Parts are ranges of doc_id between quantiles; their heads, one row per
    part, are sent to the part before as guests, so that no ordering needs a
    single task.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    shares = [(k + 1) / partitions for k in range(partitions - 1)]
    cuts = ids.select(F.percentile_approx("doc_id", shares, F.lit(10_000)).alias("cuts")).first()["cuts"] or []
    edges = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf("int")
    def part_of(doc_id):
        missing = doc_id.isna().to_numpy()
        part = np.searchsorted(edges, doc_id.fillna(0).to_numpy().astype(np.int64), side="left")
        return pd.Series(np.where(missing, -1, part).astype(np.int32))

    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("tie"))
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    heads = numbered.select(part_of("doc_id").alias("part"), order.alias("row")).groupBy("part").agg(F.max("row").alias("row"))
    every = Window.orderBy("part")
    whole = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        F.col("row.doc_id").alias("head_id"),
        F.col("row.tie").alias("head_tie"),
        F.coalesce(F.lead("part").over(every), F.first("part").over(whole)).alias("guest_of"),
    )
    mine = F.struct(part_of("doc_id").alias("part"), F.lit(False).alias("guest"))
    joined = rows.join(
        F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")), "left"
    ).withColumn("mine", mine)
    places = F.when(F.col("guest_of").isNull(), F.array("mine")).otherwise(
        F.array(F.col("mine"), F.struct(F.col("guest_of").alias("part"), F.lit(True).alias("guest")))
    )
    return joined.select("doc_id", "text", "tie", F.explode(places).alias("place")).select(
        "place.part", "place.guest", "doc_id", "tie", "text"
    )


def edited_likeness(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Digest of each text, of its edited text, and how alike they are.

    The edited text has its last floor(n / 2) code points replaced by the
    first as many (or all) of the next document, in descending doc_id; the last
    document is followed by the first.  Null doc_ids come last; rows with equal
    doc_ids follow one another by a hash of the text, descending.  A table of
    one row follows itself.  Columns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.
    """
    n = shuffle_partitions(docs.sparkSession)
    placed = _with_follower(docs, ranges or 4 * n).repartition(n, "part")
    placed = placed.sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.desc("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row = None  # doc_id, text, digest; waits for its follower
        open_part, closed = None, False
        for whole in batches:
            for batch in small_batches(whole, "text"):
                out = []
                columns = [batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")]
                for part, guest, doc_id, text in zip(*columns, strict=True):
                    if part != open_part:
                        open_row, open_part, closed = None, part, False
                    if closed:
                        continue  # a guest that came twice
                    mine = fingerprint(text)
                    if open_row is not None:
                        last_id, last, digest = open_row
                        half = len(last) // 2
                        edited = last[: len(last) - half] + text[:half]
                        changed = digest if edited == last else fingerprint(edited)
                        out.append(
                            (
                                last_id,
                                len(last),
                                hashlib.sha256(edited.encode()).hexdigest(),
                                digest,
                                changed,
                                likeness(digest, changed),
                                likeness(digest, mine),
                            )
                        )
                    open_row, closed = (doc_id, text, mine), guest
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                    arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return placed.mapInArrow(run, schema)
