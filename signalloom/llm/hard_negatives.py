"""Operator 12: hard negatives, found through summaries of vector segments.

Every vector is cut into segments, coarse ones and finer ones inside them, and
the mean and deviation of each is stored beside it.  The inner product of two
segments of length l lies within ``l * (mean * mean' +- deviation * deviation')``;
their sums over all segments bound a score from both sides.  A pair is scored
exactly only if no level of segments rules it out.

Anchors are a stated share of the rows and meet all rows in blocks: as many
anchors as fit ``CHUNK_BYTES`` go to all tasks at once, and the rows stay where
they are read.  A task returns a few best rows per anchor; those of all tasks
are ranked by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalloom.sources.scratch import materialize

# Which rows are anchors or relabelled, how many rows are taken, and the bounds of a hard negative.
ANCHOR_EVERY = 50
RELABEL_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH, WHOLE = 50, 95, 100

SEGMENT_LENGTHS = (16, 4, 2)
CHUNK_BYTES = 8 << 20
TILE_ANCHORS, TILE_ROWS = 512, 1024
_EXACT = 2.0**52  # whole numbers up to here are exact in a double
_SPARSE = 0.02
_FAR = -(1 << 62)

_PREPARED = "vec_id long, label int, dim int, v array<long>, means array<float>, deviations array<float>"


def segment_starts(dim: int) -> list[np.ndarray]:
    """Where segments begin, for each level, coarse first."""
    return [np.arange(0, dim, length) for length in SEGMENT_LENGTHS if length < dim or length == SEGMENT_LENGTHS[-1]]


def summarize(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of all segments of all levels, each times the root of the segment's length."""
    n, dim = vectors.shape
    means, deviations = [], []
    for starts in segment_starts(dim):
        lengths = np.diff(np.append(starts, dim))
        mean = np.add.reduceat(vectors, starts, axis=1) / lengths
        spread = np.add.reduceat((vectors - np.repeat(mean, lengths, axis=1)) ** 2, starts, axis=1)
        means.append(mean * np.sqrt(lengths))
        deviations.append(np.sqrt(spread))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


def _matrix(column: pa.ListArray, rows: np.ndarray, dim: int, kind: str) -> np.ndarray:
    taken = column.take(pa.array(rows))
    return taken.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(rows), dim)


def prepare(rows: DataFrame) -> DataFrame:
    """Rows that take part, relabelled, in whole numbers, with their summaries: a written table.

    Rows without id, label or vector, or with a component that is null or not
    finite, take no part.  A label below zero is shifted with SQL's remainder,
    which keeps its sign.  Of rows with one id the one with the smallest label,
    then vector, counts.  Scores exist between vectors of one length only.
    """
    x = F.col("embedding")
    broken = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~broken)
    label, number = F.col("label").cast("int"), F.col("vec_id").cast("long")
    shifted = F.when(number % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    one = usable.select(
        number.alias("vec_id"),
        F.struct(shifted.alias("label"), F.transform(x, lambda c: F.floor(c.cast("double") * 256)).alias("v")).alias("row"),
    )
    one = one.groupBy("vec_id").agg(F.min("row").alias("row"))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims = batch.column(2), pa.compute.list_value_length(batch.column(2)).to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if dim == 0:
                    means = deviations = np.zeros((len(at), 0))
                else:
                    means, deviations = summarize(_matrix(vectors, at, int(dim), "f8"))
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(at), dim, "i4")), part.column(2), _lists(means), _lists(deviations)],
                    ["vec_id", "label", "dim", "v", "means", "deviations"],
                )

    return materialize(one.select("vec_id", "row.label", "row.v").mapInArrow(summaries, _PREPARED), "vectors")


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width or 1, dtype="i4")[: n + 1] if width else np.zeros(n + 1, "i4"), pa.array(matrix.astype("f4").ravel()))


@dataclass
class Vectors:
    """Vectors of one length, with their summaries, in order of id."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    means: np.ndarray
    deviations: np.ndarray

    def take(self, at: np.ndarray | slice) -> Vectors:
        return Vectors(self.ids[at], self.labels[at], self.v[at], self.means[at], self.deviations[at])

    def __len__(self) -> int:
        return len(self.ids)


def by_length(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, Vectors]]:
    """The vectors of a batch of the prepared table, length by length."""
    if not batch.num_rows:
        return
    names = batch.schema.names
    plain = {n: batch.column(n) for n in names}
    plain = {n: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for n, c in plain.items()}
    dims, ids = plain["dim"].to_numpy(), plain["vec_id"].to_numpy()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        at = at[np.argsort(ids[at], kind="stable")]
        width = sum(len(s) for s in segment_starts(int(dim))) if dim else 0
        yield int(dim), Vectors(
            ids[at],
            plain["label"].to_numpy()[at],
            _matrix(plain["v"], at, int(dim), "i8"),
            _matrix(plain["means"], at, width, "f8"),
            _matrix(plain["deviations"], at, width, "f8"),
        )


def bounded_scores(a: Vectors, b: Vectors, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact scores of all pairs in ``alive`` whose bounds reach ``low`` and do not exceed ``high`` (per row of ``a``).

    Returns scores and the mask of pairs that have one.  Levels are tried coarse
    first; stored summaries are single precision, so bounds get a margin.
    """
    dim = a.v.shape[1]
    first = 0
    for starts in segment_starts(dim) if dim else []:
        level = slice(first, first := first + len(starts))
        ma, mb, da, db = a.means[:, level], b.means[:, level], a.deviations[:, level], b.deviations[:, level]
        middle, reach = ma @ mb.T, da @ db.T
        size = np.sqrt((ma**2).sum(1) + (da**2).sum(1))[:, None] * np.sqrt((mb**2).sum(1) + (db**2).sum(1))[None, :]
        reach += 1e-5 * size + 1.0
        alive = alive & (middle + reach >= low[:, None]) & (middle - reach <= high[:, None])
        if not alive.any():
            return np.zeros(alive.shape, "i8"), alive
        if alive.mean() < _SPARSE:
            break
    scores = np.zeros(alive.shape, "i8")
    largest = float(np.abs(a.v).max(initial=0)) * float(np.abs(b.v).max(initial=0)) * max(dim, 1)
    if alive.mean() < _SPARSE:
        i, j = np.nonzero(alive)
        scores[i, j] = (a.v[i] * b.v[j]).sum(1)
    elif largest < _EXACT:
        rows, columns = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        scores[np.ix_(rows, columns)] = np.rint(a.v[rows].astype("f8") @ b.v[columns].astype("f8").T).astype("i8")
    else:
        scores = a.v @ b.v.T
    return scores, alive


class Best:
    """The best k rows for each of n places: largest score first, of equal scores the smallest id."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), _FAR, "i8")
        self.ids = np.full((n, k), np.iinfo("i8").max, "i8")

    def least(self) -> np.ndarray:
        """A score below which nothing can enter any more."""
        return self.scores[:, -1]

    def add(self, places: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offers each place a row of scores; ids ascend along the rows, scores of ``_FAR`` are none."""
        k = self.scores.shape[1]
        some = np.flatnonzero((scores > _FAR).any(1) & (scores.max(1, initial=_FAR) >= self.least()[places]))
        if not len(some):
            return
        left, places = scores[some], places[some]
        every, which = np.arange(len(some)), np.empty((len(some), k), "i8")
        found = np.full((len(some), k), _FAR, "i8")
        for r in range(min(k, left.shape[1])):
            top = left.argmax(1)  # of equal ones the first, so the smallest id
            found[:, r], which[:, r] = left[every, top], ids[top]
            left[every, top] = _FAR
        which[found == _FAR] = np.iinfo("i8").max
        both = np.concatenate([self.scores[places], found], 1), np.concatenate([self.ids[places], which], 1)
        order = np.lexsort((both[1], -both[0]), axis=1)[:, :k]
        self.scores[places] = np.take_along_axis(both[0], order, 1)
        self.ids[places] = np.take_along_axis(both[1], order, 1)


def _tiles(a: Vectors, b: Vectors) -> Iterator[tuple[np.ndarray, Vectors, Vectors]]:
    for j in range(0, len(b), TILE_ROWS):
        rows = b.take(slice(j, j + TILE_ROWS))
        for i in range(0, len(a), TILE_ANCHORS):
            places = np.arange(i, min(i + TILE_ANCHORS, len(a)))
            yield places, a.take(places), rows


def _anchors(table: pa.Table) -> dict[int, Vectors]:
    return dict(by_length(table))




def _positives(prepared: DataFrame, chunk, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): up to ``k`` rows of a task and anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _anchors(chunk.value)
        best = {dim: Best(len(a), k) for dim, a in anchors.items()}
        for batch in batches:
            for dim, rows in by_length(batch):
                if dim not in anchors:
                    continue
                for places, a, b in _tiles(anchors[dim], rows):
                    alive = (a.labels[:, None] == b.labels[None, :]) & (a.ids[:, None] != b.ids[None, :])
                    low = best[dim].least()[places].astype("f8")
                    scores, alive = bounded_scores(a, b, alive, low, np.full(len(a), np.inf))
                    best[dim].add(places, np.where(alive, scores, _FAR), b.ids)
        for dim, a in anchors.items():
            place, rank = np.nonzero(best[dim].scores > _FAR)
            yield _batch(anchor_id=a.ids[place], positive_id=best[dim].ids[place, rank], positive_score=best[dim].scores[place, rank])

    found = prepared.mapInArrow(work, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("positive_no", F.row_number().over(order)).where(F.col("positive_no") <= k)


def _negatives(prepared: DataFrame, chunk, bounds, k: int) -> DataFrame:
    """(anchor_id, positive_no, negative_id, negative_score, rank) of the first ``k`` rows within the bounds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _anchors(chunk.value)
        limits = {dim: _limits(a.ids, *bounds.value) for dim, a in anchors.items()}
        best = {dim: [Best(len(a), k) for _ in range(limits[dim][0].shape[1])] for dim, a in anchors.items()}
        for batch in batches:
            for dim, rows in by_length(batch):
                if dim not in anchors or not best[dim]:
                    continue
                low, high = limits[dim]
                for places, a, b in _tiles(anchors[dim], rows):
                    # what a row must reach to count for any of the positives
                    least = np.stack([np.maximum(low[places, j], t.least()[places]) for j, t in enumerate(best[dim])], 1).min(1)
                    alive = a.labels[:, None] != b.labels[None, :]
                    scores, alive = bounded_scores(a, b, alive, least.astype("f8"), high[places].max(1).astype("f8"))
                    for j, top in enumerate(best[dim]):
                        fits = alive & (scores >= low[places, j, None]) & (scores <= high[places, j, None])
                        top.add(places, np.where(fits, scores, _FAR), b.ids)
        for dim, a in anchors.items():
            for j, top in enumerate(best[dim]):
                place, rank = np.nonzero(top.scores > _FAR)
                yield _batch(
                    anchor_id=a.ids[place], positive_no=np.full(len(place), j + 1, "i4"), negative_id=top.ids[place, rank], negative_score=top.scores[place, rank]
                )

    found = prepared.mapInArrow(work, "anchor_id long, positive_no int, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_no").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _limits(ids: np.ndarray, anchor: np.ndarray, number: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of a hard negative per anchor and positive; low above high where there is none."""
    width = int(number.max(initial=0))
    low = np.full((len(ids), width), np.iinfo("i8").max // 2, "i8")
    high = np.full((len(ids), width), _FAR, "i8")
    order = np.argsort(ids, kind="stable")
    at = np.searchsorted(ids, anchor, sorter=order)
    there = at < len(ids)
    at = order[np.where(there, at, 0)] if len(ids) else at
    mine = there & (ids[at] == anchor) if len(ids) else there
    low[at[mine], number[mine] - 1] = -((-LOW * score[mine]) // WHOLE)
    high[at[mine], number[mine] - 1] = (HIGH * score[mine]) // WHOLE
    return low, high


def _batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


def mine_hard_negatives(
    rows: DataFrame, anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` holds vec_id, embedding, label; other columns are not read.
    Anchors are the rows whose id is divisible by ``anchor_every``; what is left
    out and how repeated ids count is said at ``prepare``.  An anchor without
    positives, or a positive without negatives, gives no rows.
    """
    spark = rows.sparkSession
    prepared = prepare(rows)
    mine = prepared.where(F.col("vec_id") % anchor_every == 0)
    size = mine.agg(F.sum(F.col("dim") * 8 + F.size("means") * 8 + 16).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    parts = -(-(size["bytes"] or 0) // chunk_bytes)
    found = None
    for part in range(parts):
        # ids are distinct, so their hashes deal them evenly
        here = mine.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part)
        chunk = spark.sparkContext.broadcast(here.toArrow())
        near = materialize(_positives(prepared, chunk, positives), "positives")
        scores = near.select("anchor_id", "positive_no", "positive_score").toArrow()
        bounds = spark.sparkContext.broadcast(tuple(scores.column(i).to_numpy() for i in range(3)))
        far = materialize(_negatives(prepared, chunk, bounds, negatives), "negatives")
        pairs = near.join(far, ["anchor_id", "positive_no"])
        found = pairs if found is None else found.union(pairs)
        chunk.unpersist()
        bounds.unpersist()
    if found is None:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], schema)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
