"""Operator 6: repeated byte strings, found by a logarithmic family of suffix arrays.

A string of ``LENGTH`` bytes is a repeat if it also starts earlier.  Suffixes are
taken at anchors only: of every ``WINDOW`` neighbouring 32-byte hashes the
smallest is one, so equal strings of ``LENGTH`` bytes hold the same anchor at
the same place, and anchors are one position in 35.  Suffixes with one anchor
hash meet in one shard.

A shard reads its suffixes in document order.  Each batch gets a suffix array of
what follows the anchors and one of what comes before them, reversed; it is
merge-scanned against itself and against every older level.  Two suffixes agree
on the string that starts d bytes before the anchor if they share d bytes to the
left and ``LENGTH`` - d to the right; both are cuts in the lists of common
prefix lengths, so all of it is exact.  Suffixes that brought something new
become a level, and levels of like size are merged.

Three things come first, so that little text moves.  The same scan inside each
task lets a passage that fills the corpus leave the task once.  Anchors that no
other task has are dropped.  Where all bytes around two anchors agree, by a
64-bit hash of them, only the first goes on: long copies are settled by numbers
alone, and suffixes are needed where copies begin and end.

An anchor hash with more than ``HOT_ROWS`` such rows is not given to one task:
a passage shared by different texts has one at each edge.  Its strings go on
singly, by a 128-bit digest, and each task first drops those it has met before,
so that a string all texts share comes from each task about once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.llm.common import small_batches, whole_text, with_mark

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1
#: Most bytes left of an anchor that a string through it can have.
LEFT = WINDOW - 1
BATCH_ROWS = 1 << 15
#: Most rows of one anchor hash that meet as suffixes; a batch holds as many anyway.
HOT_ROWS = BATCH_ROWS
#: Strings of hot anchors that a task compares before it sends them on.
HELD_STRINGS = 1 << 18
SLICE_BYTES = 4 << 20
#: Texts are scanned in pieces up to this size; a place takes 24 bits.
PIECE_BYTES = 1 << 23
_PLACE_BITS = 24
#: Added to the place of a hot anchor, and to the start of one of its strings.
_HOT = 1 << 62
_NO_ID = -(1 << 63)

_BYTE_CODES = np.random.default_rng(61).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes at each position, joined from halves."""
    h, factor, width = _BYTE_CODES[data], np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * factor + h[width:]
            factor, width = factor * factor, 2 * width
    return _mix(h)


@dataclass
class Anchors:
    """Suffix positions: hash, place, the first and last start of strings through them.

    ``check`` hashes all bytes of these strings.
    """

    hash: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    check: np.ndarray


def find_anchors(data: np.ndarray, ends: np.ndarray) -> Anchors:
    """Anchors of texts that lie behind one another in ``data`` and end at ``ends``."""
    if len(data) < LENGTH:
        none = np.empty(0, np.int64)
        return Anchors(none.astype(np.uint64), none, none, none, none)
    hashes = gram_hashes(data)
    low_bits = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low_bits) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[: len(least) - (WINDOW - width)], least[WINDOW - width :])
    inside = np.zeros(len(data) + 1, np.int8)
    begins = np.concatenate([[0], ends[:-1]])
    long_enough = ends - begins >= LENGTH
    np.add.at(inside, begins[long_enough], 1)
    np.add.at(inside, ends[long_enough] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[: len(least)])
    chosen = (least[starts] & low_bits).astype(np.int64)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], len(chosen)) - 1
    at, low, high = chosen[first], starts[first], starts[last]
    check, end = np.zeros(len(at), np.uint64), high + LENGTH - GRAM
    for step in range(0, LENGTH + WINDOW, GRAM):
        check = _mix(check + hashes[np.minimum(low + step, end)]) + (at - low).astype(np.uint64)
    return Anchors(hashes[at], at, low, high, _mix(check + (high - low).astype(np.uint64)).view(np.int64))


@dataclass
class Suffixes:
    """Rows with what follows (``right``) and, reversed, what precedes (``left``) an anchor.

    Strings through the anchor start ``near`` to ``far`` bytes before it.
    """

    hash: np.ndarray
    right: np.ndarray
    left: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def __len__(self) -> int:
        return len(self.hash)

    def take(self, rows: np.ndarray) -> Suffixes:
        return Suffixes(self.hash[rows], self.right[rows], self.left[rows], self.near[rows], self.far[rows])

    def followed_by(self, other: Suffixes) -> Suffixes:
        pairs = ((self.hash, other.hash), (self.right, other.right), (self.left, other.left))
        return Suffixes(*map(np.concatenate, (*pairs, (self.near, other.near), (self.far, other.far))))


def cut_suffixes(data: np.ndarray, a: Anchors) -> Suffixes:
    """The bytes around anchors; zeros stand where no string through the anchor reaches."""
    near, far = a.at - a.high, a.at - a.low

    def gather(places: np.ndarray, known: np.ndarray) -> np.ndarray:
        out = data[np.where(known, places, 0)]
        out[~known] = 0
        return out

    step = np.arange(LENGTH)
    right = gather(a.at[:, None] + step, step < (LENGTH - near)[:, None])
    step = np.arange(LEFT)
    left = gather(a.at[:, None] - 1 - step, step < far[:, None])
    return Suffixes(a.hash, right, left, near, far)


def _strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix length of each row, in ``order``, with the row before; 0 for the first."""
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    length = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.concatenate([[0], length])


class Level:
    """Suffixes with their two suffix arrays."""

    def __init__(self, rows: Suffixes, by_right: np.ndarray | None = None, by_left: np.ndarray | None = None):
        self.rows = rows
        self.by_right = np.argsort(_strings(rows.right), kind="stable") if by_right is None else by_right
        self.by_left = np.argsort(_strings(rows.left), kind="stable") if by_left is None else by_left

    def __len__(self) -> int:
        return len(self.rows)

    def only(self, keep: np.ndarray) -> Level:
        """The level without other rows; both orders stay sorted."""
        number = np.cumsum(keep) - 1
        return Level(
            self.rows.take(np.flatnonzero(keep)),
            number[self.by_right[keep[self.by_right]]],
            number[self.by_left[keep[self.by_left]]],
        )

    def merged(self, newer: Level) -> Level:
        """Both levels in one, by merging their sorted arrays."""

        def merge(mine: np.ndarray, mine_order: np.ndarray, other: np.ndarray, other_order: np.ndarray) -> np.ndarray:
            at = np.searchsorted(_strings(mine[mine_order]), _strings(other[other_order]), side="right")
            return np.insert(mine_order, at, other_order + len(mine_order))

        return Level(
            self.rows.followed_by(newer.rows),
            merge(self.rows.right, self.by_right, newer.rows.right, newer.by_right),
            merge(self.rows.left, self.by_left, newer.rows.left, newer.by_left),
        )

    def repeats(self) -> np.ndarray:
        """For each row and each d from 0 to ``LEFT``: an earlier row has the string from d bytes before."""
        n, rows = len(self), self.rows
        out = np.zeros((n, WINDOW), bool)
        right, left = _common(rows.right, self.by_right), _common(rows.left, self.by_left)
        right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
        for d in range(WINDOW):
            active = np.flatnonzero((rows.near <= d) & (d <= rows.far))
            if len(active) < 2:
                continue
            right_class[self.by_right] = np.cumsum(right < LENGTH - d)
            left_class[self.by_left] = np.cumsum(left < d) if d else 0
            key = right_class[active] * (n + 1) + left_class[active]
            _, first, which = np.unique(key, return_index=True, return_inverse=True)
            out[active, d] = first[which] < np.arange(len(active))
        return out


def _shared(hashes: np.ndarray) -> np.ndarray:
    """True where another row has the same hash."""
    _, which, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return count[which] > 1


class Family:
    """Levels of suffixes, the largest first; each at least twice as large as the next."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def add(self, rows: Suffixes) -> np.ndarray:
        """Take in a batch that comes after all before; which of its strings are repeats.

        The result has a row for each row and a column for each start, counted
        in bytes before the anchor.
        """
        found = np.zeros((len(rows), WINDOW), bool)
        inner = np.flatnonzero(_shared(rows.hash))
        if len(inner):
            found[inner] |= Level(rows.take(inner)).repeats()
        for level in self.levels:
            mine = np.flatnonzero(np.isin(rows.hash, level.rows.hash))
            if not len(mine):
                continue
            older = level.only(np.isin(level.rows.hash, rows.hash[mine]))
            found[mine] |= older.merged(Level(rows.take(mine))).repeats()[len(older) :]
        reach = np.arange(WINDOW)
        starts = (rows.near[:, None] <= reach) & (reach <= rows.far[:, None])
        fresh = np.flatnonzero((starts & ~found).any(axis=1))
        if len(fresh):
            self.levels.append(Level(rows.take(fresh)))
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) > len(self.levels[-2]):
            newer = self.levels.pop()
            self.levels.append(self.levels.pop().merged(newer))
        return found


def _runs(found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first byte and end of the areas that repeated strings cover."""
    ahead = found[:, ::-1]  # by ascending start
    edge = np.diff(np.pad(ahead, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return row, at[row] - LEFT + begin, at[row] - LEFT + end - 1 + LENGTH


def _place(low: np.ndarray, at: np.ndarray, high: np.ndarray) -> np.ndarray:
    """An anchor in one number: first start, then two distances."""
    return low << 16 | (at - low) << 8 | (high - low)


def _area(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """An area of less than 16 MiB in one negative number."""
    return -1 - (begin << _PLACE_BITS | (end - begin))


def _pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Pieces of a long text that hold each string of ``LENGTH`` bytes once."""
    step = PIECE_BYTES - LENGTH + 1
    for start in range(0, max(1, len(text) - LENGTH + 1), step):
        yield start, text[start : start + PIECE_BYTES]


def _scan_slice(docs: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
    """Anchors that other tasks must hear of and areas that repeat inside the slice."""
    pieces = [(d, tie, start, p) for d, tie, text in docs for start, p in _pieces(text)]
    out = {k: [] for k in _NAMES}
    family = Family()
    group: list[tuple[int, int, int, bytes]] = []
    held = 0

    def flush() -> None:
        data = np.frombuffer(b"".join(p for *_, p in group), np.uint8)
        ends = np.cumsum([len(p) for *_, p in group])
        anchors = find_anchors(data, ends)
        owner = np.searchsorted(ends, anchors.at, side="right")
        d, tie = (np.array([g[k] for g in group], np.int64) for k in (0, 1))
        offset = np.array([g[2] for g in group], np.int64) - np.concatenate([[0], ends[:-1]])
        keep = np.ones(len(anchors.at), bool)
        seen = [level.rows.hash for level in family.levels]
        alike = np.flatnonzero(_shared(anchors.hash) | np.isin(anchors.hash, np.concatenate([anchors.hash[:0], *seen])))
        if len(alike):
            some = Anchors(*(getattr(anchors, f.name)[alike] for f in fields(Anchors)))
            rows = cut_suffixes(data, some)
            found = family.add(rows)
            row, begin, end = _runs(found, some.at)
            who = owner[alike[row]]
            out["hash"].append(_mix((begin + d[who] * 31).astype(np.uint64)).view(np.int64))
            out["check"].append(np.zeros(len(who), np.int64))
            out["d"].append(d[who])
            out["tie"].append(tie[who])
            out["at"].append(_area(begin + offset[who], end + offset[who]))
            keep[alike] = found.sum(axis=1) < rows.far - rows.near + 1
        who, move = owner[keep], offset[owner[keep]]
        out["hash"].append(anchors.hash[keep].view(np.int64))
        out["check"].append(anchors.check[keep])
        out["d"].append(d[who])
        out["tie"].append(tie[who])
        out["at"].append(_place(anchors.low[keep] + move, anchors.at[keep] + move, anchors.high[keep] + move))

    for piece in pieces:
        if group and held + len(piece[3]) > PIECE_BYTES:
            flush()
            group, held = [], 0
        group.append(piece)
        held += len(piece[3])
    if group:
        flush()
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}


def _batch(columns: dict[str, np.ndarray], **more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()} | more)


_NAMES = ("hash", "check", "d", "tie", "at")
_ROW = "hash long, check long, d long, tie long, at long"
_MET = "hash long, d long, tie long, at long"


def _numbers(batch: pa.RecordBatch, *names: str) -> dict[str, np.ndarray]:
    return {n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in small_batches(whole, "text", SLICE_BYTES):
            rows = zip(*[batch.column(c).to_pylist() for c in ("d", "tie", "text")], strict=True)
            unique = {(d, tie): text for d, tie, text in rows}
            yield _batch(_scan_slice([(*key, unique[key]) for key in sorted(unique)]))


def _met(batches: Iterator[pa.RecordBatch], hot_rows: int = HOT_ROWS) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash, check and document, what has to go on.

    A row with the hash and check of the row before becomes an area.  The first
    of each check goes on if its hash has another check, too, and is marked if
    its hash has more than ``hot_rows``.  Areas pass.
    """
    names = ("hash", "d", "tie", "at")
    last: dict[str, np.ndarray] | None = None  # the row before
    held = {k: np.empty(0, np.int64) for k in names}  # firsts of the last hash, as long as it is not hot
    hot: int | None = None  # the last hash, if it is
    for batch in batches:
        rows = _numbers(batch, *_NAMES)
        passing = rows["at"] < 0
        if passing.any():
            yield _batch({k: rows[k][passing] for k in names})
        rows = {k: v[~passing] for k, v in rows.items()}
        n = len(rows["at"])
        if not n:
            continue
        before = {k: np.concatenate([last[k] if last else v[:1], v[:-1]]) for k, v in rows.items()}
        same = {k: rows[k] == before[k] for k in _NAMES}
        new = ~(same["hash"] & same["check"])
        new[0] |= last is None
        twice = ~new & same["d"] & same["tie"] & same["at"]
        last = {k: v[-1:] for k, v in rows.items()}
        copies = ~new & ~twice
        if copies.any():
            low = rows["at"][copies] >> 16
            area = _area(low, low + (rows["at"][copies] & 255) + LENGTH)
            yield _batch({k: rows[k][copies] for k in ("hash", "d", "tie")} | {"at": area})
        firsts = {k: np.concatenate([held[k], rows[k][new]]) for k in names}
        if not len(firsts["at"]):
            continue
        begin = np.flatnonzero(np.concatenate([[True], firsts["hash"][1:] != firsts["hash"][:-1]]))
        size = np.diff(np.append(begin, len(firsts["at"])))
        marked = (size > hot_rows) | ((firsts["hash"][begin] == hot) if hot is not None else False)
        hot = int(firsts["hash"][-1]) if marked[-1] else None
        on = marked | (size > 1)
        on[-1] = marked[-1]
        held = {k: v[len(v) if marked[-1] else begin[-1] :] for k, v in firsts.items()}
        firsts["at"] = firsts["at"] + np.repeat(marked, size) * _HOT
        on = np.repeat(on, size)
        if on.any():
            yield _batch({k: v[on] for k, v in firsts.items()})
    if len(held["at"]) > 1:
        yield _batch(held)


class Strings:
    """Strings of hot anchors, by digest; those that a task has met before end here."""

    def __init__(self) -> None:
        self.held: list[dict[str, np.ndarray]] = []
        self.count = 0

    def add(self, text: bytes, d: int, tie: int, at: np.ndarray) -> None:
        """All strings through the anchors at ``at`` of a document."""
        low, n = at >> 16, (at & 255) + 1
        starts = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        digests = b"".join(hashlib.blake2b(text[s : s + LENGTH], digest_size=16).digest() for s in starts.tolist())
        hash_, check = np.frombuffer(digests, "<i8").reshape(-1, 2).T
        columns = {"hash": hash_, "check": check, "d": np.full(len(starts), d), "tie": np.full(len(starts), tie), "at": starts}
        self.held.append(columns)
        self.count += len(starts)

    def settle(self) -> Iterator[pa.RecordBatch]:
        """The first of each string goes on, others become areas."""
        if not self.count:
            return
        rows = {k: np.concatenate([h[k] for h in self.held]) for k in _NAMES}
        self.held, self.count = [], 0
        order = np.lexsort([rows[k] for k in reversed(_NAMES)])
        rows = {k: v[order] for k, v in rows.items()}
        alike = {k: np.concatenate([[False], v[1:] == v[:-1]]) for k, v in rows.items()}
        new = ~(alike["hash"] & alike["check"])
        copies = ~new & ~(alike["d"] & alike["tie"] & alike["at"])
        around = pa.array([c.tobytes() for c in rows["check"][new]], pa.binary())
        yield _batch({k: rows[k][new] for k in ("hash", "d", "tie")} | {"at": rows["at"][new] + _HOT}, around=around)
        d, tie, at = (rows[k][copies] for k in ("d", "tie", "at"))
        order = np.lexsort([at, tie, d])
        d, tie, at = d[order], tie[order], at[order]
        joined = np.concatenate([[False], (np.diff(d) == 0) & (np.diff(tie) == 0) & (np.diff(at) == 1)])
        first = np.flatnonzero(~joined)
        end = at[np.append(first[1:], len(at)) - 1] if len(first) else at
        for a in range(0, len(first), BATCH_ROWS):
            some = first[a : a + BATCH_ROWS]
            areas = {"d": d[some], "tie": tie[some], "at": _area(at[some], end[a : a + BATCH_ROWS] + LENGTH)}
            hashes = _mix((areas["at"] + areas["d"] * 31).astype(np.uint64)).view(np.int64)
            yield _batch({"hash": hashes} | areas, around=pa.array([b""] * len(some), pa.binary()))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the anchors of each document, or its strings where they are hot.

    Areas of a document are merged and pass.
    """
    unpack = zstandard.ZstdDecompressor().decompress
    strings = Strings()
    for whole in batches:
        for batch in small_batches(whole, "packed", 1 << 20):
            for k in range(len(batch)):
                whole_bytes = unpack(batch.column("packed")[k].as_py())
                text = np.frombuffer(whole_bytes, np.uint8)
                hashes, at = (np.asarray(batch.column(c)[k].values) for c in ("hashes", "places"))
                hot = at >= _HOT
                if hot.any():
                    strings.add(whole_bytes, batch.column("d")[k].as_py(), batch.column("tie")[k].as_py(), at[hot] - _HOT)
                    hashes, at = hashes[~hot], at[~hot]
                areas = [
                    (start, min(start + PIECE_BYTES, end))
                    for begin, end in merge_areas(at[at < 0].tolist())
                    for start in range(begin, end, PIECE_BYTES)
                ]
                areas = np.array(areas, np.int64).reshape(-1, 2)
                hashes = np.concatenate([hashes[at >= 0], _mix((areas[:, 0] + at.size).astype(np.uint64)).view(np.int64)])
                at = np.concatenate([at[at >= 0], _area(areas[:, 0], areas[:, 1])])
                low, span = at >> 16, (at & 255) + LENGTH
                size = np.where(at >= 0, span, 0)
                ends = np.cumsum(size)
                begin = np.where(at >= 0, low, 0)
                flat = text[np.repeat(begin - (ends - size), size) + np.arange(size.sum())]
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                bytes_ = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
                yield _batch(
                    {
                        "hash": hashes,
                        "d": np.full(len(at), batch.column("d")[k].as_py()),
                        "tie": np.full(len(at), batch.column("tie")[k].as_py()),
                        "at": at,
                    },
                    around=bytes_,
                )
                if strings.count >= HELD_STRINGS:
                    yield from strings.settle()
    yield from strings.settle()


def _suffix_rows(hashes: np.ndarray, at: np.ndarray, around: pa.Array) -> tuple[np.ndarray, Suffixes]:
    """Absolute places of the anchors and their suffixes, from what ``_cut`` wrote."""
    low, far, spread = at >> 16, at >> 8 & 255, at & 255
    data = np.frombuffer(b"".join(around.to_pylist()), np.uint8)
    begin = np.concatenate([[0], np.cumsum(spread + LENGTH)])[:-1]
    anchors = Anchors(hashes.view(np.uint64), begin + far, begin, begin + spread, hashes)
    return low + far, cut_suffixes(data, anchors)


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Areas from the suffixes of a shard, which come in document order.

    Strings of hot anchors come among them in order of digest and document: all
    but the first row of each are repeats.
    """
    family, last = Family(), None
    last_string: dict[str, np.ndarray] | None = None
    held: list[pa.RecordBatch] = []

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        n = {c: table.column(c).to_numpy().astype(np.int64) for c in ("hash", "d", "tie", "at")}
        at, suffixes = _suffix_rows(n["hash"], n["at"], table.column("around").combine_chunks())
        row, begin, end = _runs(family.add(suffixes), at)
        return _batch({"d": n["d"][row], "tie": n["tie"][row], "at": _area(begin, end)})

    count = 0
    for batch in batches:
        string = batch.column("at").to_numpy(zero_copy_only=False) >= _HOT
        if string.any():
            hot = batch.filter(pa.array(string))
            rows = _numbers(hot, "hash", "d", "tie", "at")
            rows["check"] = np.frombuffer(b"".join(hot.column("around").to_pylist()), "<i8")
            alike = {k: v == np.concatenate([last_string[k] if last_string else v[:1], v[:-1]]) for k, v in rows.items()}
            again = alike["hash"] & alike["check"] & ~(alike["d"] & alike["tie"] & alike["at"])
            again[0] &= last_string is not None
            last_string = {k: v[-1:] for k, v in rows.items()}
            start = rows["at"][again] - _HOT
            yield _batch({"d": rows["d"][again], "tie": rows["tie"][again], "at": _area(start, start + LENGTH)})
            batch = batch.filter(pa.array(~string))
        n = _numbers(batch, "d", "tie", "at")
        same = np.zeros(len(batch), bool)  # a row that came twice
        same[1:] = (n["d"][1:] == n["d"][:-1]) & (n["tie"][1:] == n["tie"][:-1]) & (n["at"][1:] == n["at"][:-1])
        if len(batch):
            same[0] = last == (n["d"][0], n["tie"][0], n["at"][0])
            last = (n["d"][-1], n["tie"][-1], n["at"][-1])
        areas = n["at"] < 0
        if areas.any():
            yield _batch({k: v[areas] for k, v in n.items()})
        held.append(batch.filter(pa.array(~areas & ~same)))
        count += len(held[-1])
        if count >= BATCH_ROWS:
            yield settle(held)
            held, count = [], 0
    if count:
        yield settle(held)


def merge_areas(areas: list[int] | None) -> list[tuple[int, int]]:
    """Maximal areas, in order, of encoded ones."""
    out: list[tuple[int, int]] = []
    for code in sorted((-1 - a for a in areas or ()), key=lambda c: c >> _PLACE_BITS):
        begin = code >> _PLACE_BITS
        end = begin + (code & (1 << _PLACE_BITS) - 1)
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _with_ties(docs: DataFrame) -> DataFrame:
    """d, tie, text: a document is found again by (d, tie).

    The tie is a 64-bit hash of the text where the doc_id may be repeated, else
    0, which takes no room in a shuffle.  Repeated doc_ids are marked in a bit
    table of fixed size; other doc_ids that share a bit get a tie in vain.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("d")
    repeated = docs.select(doc_id).groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = with_mark(docs.select(doc_id, whole_text().alias("text")), F.xxhash64("d"), repeated, F.xxhash64("d"), "again")
    tie = F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return rows.select("d", F.col("text").cast("binary").alias("text"), tie.alias("tie"))


def remove_repeats(docs: DataFrame, with_text: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per document.

    Bytes are those of the UTF-8 text, a null text is empty.  Earlier is the
    smaller doc_id, then the earlier place; a null doc_id comes first.  Texts
    with the same doc_id are told apart and ordered by a 64-bit hash; rows equal
    in doc_id and text count as one document, reported for each row.  ``with_text`` adds the
    areas removed and the bytes kept.  Results do not depend on ``hot_rows``.
    """
    rows = _with_ties(docs)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for whole in batches:
            for batch in small_batches(whole, "text"):
                packed = pa.array([pack(t) for t in batch.column("text").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_pydict({"d": batch.column("d"), "tie": batch.column("tie"), "packed": packed})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for batch in small_batches(whole, "packed", 1 << 20):
                out = []
                for d, packed, areas in zip(*[batch.column(c).to_pylist() for c in ("d", "packed", "areas")], strict=True):
                    data, spans = unpack(packed), merge_areas(areas)
                    edges = [0, *[e for s in spans for e in s], len(data)]
                    kept = b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                    row = (None if d == _NO_ID else d, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                    out.append(row + (spans, kept) if with_text else row)
                kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.list_(pa.int64())), pa.binary()] * with_text
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

    met = rows.mapInArrow(_scan, _ROW).repartition("hash").sortWithinPartitions(*_NAMES)
    met = met.mapInArrow(lambda b: _met(b, hot_rows), _MET)
    by_text = met.groupBy("d", "tie").agg(F.collect_list(F.struct("hash", "at")).alias("rows"))
    by_text = by_text.select("d", "tie", F.col("rows.hash").alias("hashes"), F.col("rows.at").alias("places"))
    packed = rows.mapInArrow(shrink, "d long, tie long, packed binary")
    around = packed.join(by_text, ["d", "tie"]).mapInArrow(_cut, _MET + ", around binary")
    string = F.col("at") >= _HOT
    in_order = (F.when(string, F.col("hash")).otherwise(F.col("d")), F.when(string, F.col("around")), "d", "tie", "at")
    areas = around.repartition("hash").sortWithinPartitions(*in_order).mapInArrow(_match, "d long, tie long, at long")
    areas = areas.groupBy("d", "tie").agg(F.collect_list("at").alias("areas"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        schema += ", removed array<array<long>>, kept binary"
    return packed.join(areas, ["d", "tie"], "left").select("d", "packed", "areas").mapInArrow(finish, schema)
