"""Operator 10: hierarchical packing into sequences of several lengths.

A document of n tokens gives full windows of the longest tier; its rest goes to
the smallest tier that holds it.  Each tier packs its pieces best-fit; gaps of
long windows are filled from shorter tiers, and what no whole piece fills is
closed by cutting one.  Sequences of a tier are dealt to step groups of equal
token counts, so that every group has one shape.

Nothing is shuffled: tasks pack the documents of their own input split, block
by block, so memory is bounded by a block and no key can be hot.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import release_memory, small_batches, whole_text
from signalloom.llm.encoding import default_vocabulary, with_end, word_cache

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 1 << 16
BLOCK_CHARS = 16 << 20
#: So much text is encoded at once: the encoder's own tables take many times its size.
ENCODE_CHARS = 1 << 20
# ids of sequences and groups: the task in the high bits
_TASK_SHIFT = 40

Piece = tuple[int, int, int]  # document in the block, start, length


class TierPools:
    """Pieces that wait for a place, by tier, each tier ordered by length."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.pools: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}

    def route(self, length: int) -> int:
        return self.tiers[bisect.bisect_left(self.tiers, length)]

    def load(self, pieces: list[Piece]) -> None:
        for doc, start, length in pieces:
            self.pools[self.route(length)].append((length, doc, start))
        for pool in self.pools.values():
            pool.sort()

    def put(self, piece: Piece) -> None:
        doc, start, length = piece
        bisect.insort(self.pools[self.route(length)], (length, doc, start))

    def longest(self, tier: int) -> Piece | None:
        if not self.pools[tier]:
            return None
        length, doc, start = self.pools[tier].pop()
        return doc, start, length

    def best_fit(self, room: int, tier: int) -> Piece | None:
        """The longest piece of ``tier`` or a shorter one that fits ``room``."""
        for t in reversed([t for t in self.tiers if t <= tier]):
            pool = self.pools[t]
            k = bisect.bisect_right(pool, (room, 1 << 62, 1 << 62))
            if k:
                length, doc, start = pool.pop(k - 1)
                return doc, start, length
        return None

    def cut(self, room: int, tier: int) -> Piece | None:
        """The first ``room`` tokens of a longer piece of ``tier``; its rest stays."""
        for t in [t for t in self.tiers if t <= tier]:
            if self.pools[t] and self.pools[t][-1][0] > room:
                length, doc, start = self.pools[t].pop()
                self.put((doc, start + room, length - room))
                return doc, start, room
        return None


def pack_lengths(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Sequences of pieces that hold each token of the documents once.

    Every sequence but the last few is full at its tier's length; the tokens
    left at the end are cut into powers of two, which need no padding.
    """
    top, pieces, sequences = tiers[-1], [], []
    for doc, n in enumerate(lengths):
        whole = n // top * top
        sequences += [[(doc, start, top)] for start in range(0, whole, top)]
        if n > whole:
            pieces.append((doc, whole, n - whole))
    pools = TierPools(tiers)
    pools.load(pieces)
    for tier in reversed(tiers):
        while (piece := pools.longest(tier)) is not None:
            window, room = [piece], tier - piece[2]
            while room:
                piece = pools.best_fit(room, tier) or pools.cut(room, tier)
                if piece is None:
                    break
                window.append(piece)
                room -= piece[2]
            if room:
                return sequences + _tail(window, tier - room)
            sequences.append(window)
    return sequences


def _tail(window: list[Piece], total: int) -> list[list[Piece]]:
    out, queue = [], window[::-1]
    while total:
        room = size = 1 << (total.bit_length() - 1)
        sequence = []
        while room:
            doc, start, length = queue.pop()
            take = min(room, length)
            sequence.append((doc, start, take))
            if length > take:
                queue.append((doc, start + take, length - take))
            room -= take
        out.append(sequence)
        total -= size
    return out


def encoded_blocks(
    batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int = END_ID, block_chars: int = BLOCK_CHARS
) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """doc_ids, all ids in a row and the number of ids of each document, block by block."""
    names, ids, sizes, held = [], [], [], 0

    def sealed() -> tuple[list, np.ndarray, np.ndarray]:
        """The block; what it was put together from is let go."""
        nonlocal names, ids, sizes, held
        block = names, np.concatenate(ids), np.concatenate(sizes)
        names, ids, sizes, held = [], [], [], 0
        return block

    for whole in batches:
        for batch in small_batches(whole, "text", min(ENCODE_CHARS, block_chars // 4)):
            flat, lengths = with_end(*word_cache(vocabulary).encode(batch.column("text").to_pylist()), end_id)
            names += batch.column("doc_id").to_pylist()
            ids.append(flat)
            sizes.append(lengths)
            held += batch.column("text").nbytes
            if held >= block_chars:
                yield sealed()
    if names:
        yield sealed()


PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier long, step_group long"
)


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    tiers: tuple[int, ...] = TIERS,
    end_id: int = END_ID,
    step_tokens: int = STEP_TOKENS,
    block_chars: int = BLOCK_CHARS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it starts, its sequence and its place there.

    ``tiers`` are powers of two in ascending order.  ``tier`` is the length of
    the sequence; sequences of one ``step_group`` have the same tier and
    ``step_tokens`` tokens together (the last group of a tier in a task may have
    fewer).  A null text is empty and gives its end id; a null doc_id stays
    null.  Equal rows are packed each on its own.  An empty table gives no
    rows.  ``with_ids`` adds the ids of the piece.
    """
    vocabulary = vocabulary or default_vocabulary()
    if any(t & (t - 1) for t in tiers) or sorted(tiers) != list(tiers):
        raise ValueError("tiers must be ascending powers of two")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << _TASK_SHIFT
        sequence_id, group_id = task, task
        open_groups: dict[int, tuple[int, int]] = {}  # tier: group, tokens so far

        def packed(names: list, flat: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
            nonlocal sequence_id, group_id
            starts = np.cumsum(sizes) - sizes
            data = memoryview(flat.astype("<u4", copy=False)).cast("B")
            rows = []
            for sequence in pack_lengths(sizes.tolist(), tiers):
                tier = sum(p[2] for p in sequence)
                group, tokens = open_groups.get(tier, (None, step_tokens))
                if tokens >= step_tokens:
                    group, tokens = group_id, 0
                    group_id += 1
                open_groups[tier] = (group, tokens + tier)
                offset = 0
                for doc, start, length in sequence:
                    at = 4 * (int(starts[doc]) + start)
                    piece = data[at : at + 4 * length]
                    row = (names[doc], start, length, zlib.crc32(piece), int(sizes[doc]), sequence_id, offset, tier, group)
                    rows.append(row + (np.frombuffer(piece, "<u4"),) if with_ids else row)
                    offset += length
                sequence_id += 1
            kinds = [pa.int64()] * 9 + [pa.list_(pa.int64())] * with_ids
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

        # no block outlives its call
        yield from itertools.starmap(packed, encoded_blocks(batches, vocabulary, end_id, block_chars))
        release_memory()

    schema = PIECE_SCHEMA + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(pack, schema)
