"""Pairing timer marks in a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from signalloom.streaming.state import PIECE_ROWS, Packing, from_micros, milliseconds, with_time

_UNREAD = object()


class OpenMarks(StatefulProcessor):
    """The open start of a key: closed by its stop, replaced by a later start, dropped after its lifetime."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], lifetime: int | None, packing: Packing):
        self._keys, self._columns, self._lifetime = tuple(keys), (*order, "start_at", "end_at"), lifetime
        self._packing = packing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        marks = self._packing.unpacked(rows, timerValues.getCurrentWatermarkInMs())
        first = next(marks, None)
        if first is None:
            return
        # a start that comes first replaces what was open, whatever it was, unless that has a timer
        stored = _UNREAD if self._lifetime is None and first[-1] == "start" else self._stored()
        start, pairs = stored, []
        for at, *rest, kind in chain((first,), marks):
            if kind == "start":
                start = at
                continue
            if kind == "stop" and start is not None and not self._is_over(start, at):
                pairs.append((*rest, start, at))
                if len(pairs) == PIECE_ROWS:
                    yield self._lists(key, pairs)
                    pairs = []
            start = None
        if pairs:
            yield self._lists(key, pairs)
        if start != stored:
            self._keep(stored, start)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self._open.clear()
        return iter(())

    def _stored(self) -> int | None:
        held = self._open.get()
        return held[0] if held is not None else None

    def _lists(self, key: Any, pairs: list[tuple]) -> Row:
        return Row(**{f"__key{i}": v for i, v in enumerate(key)}, **{f"__{c}": list(v) for c, v in zip(self._columns, zip(*pairs))})

    def _is_over(self, start: int, at: int) -> bool:
        return self._lifetime is not None and at - start > self._lifetime

    def _keep(self, stored: int | None, start: int | None) -> None:
        if self._lifetime is not None and stored is not None:
            self._handle.deleteTimer(milliseconds(stored + self._lifetime))
        if start is None:
            self._open.clear()
            return
        self._open.update((start,))
        if self._lifetime is not None:
            self._handle.registerTimer(milliseconds(start + self._lifetime))


def stream_pairs(
    marks: DataFrame,
    lifetime_ms: int | None = None,
    by: Sequence[str] = ("client", "name"),
    order: Sequence[str] = ("ts", "mark_id"),
    delay: str = "1 minute",
) -> DataFrame:
    """T1 over a stream of ``*by, *order, kind``: the columns of ``pair_timers``, as each stop arrives.

    The state is one start per key.  With ``lifetime_ms`` a stop that comes later
    than that pairs with nothing, and the start leaves the state as soon as the
    watermark has passed it: what a batch costs depends on the keys in it and on
    the starts that expire, not on all that are open.  Without it starts stay
    until they are closed.

    Marks of a key must arrive in order from batch to batch; inside a batch they
    are sorted, those of one key and batch in one task, on disk where they are
    many, and travel to Python as lists.  Marks without a time, and those that
    lie ``delay`` or more behind the newest of earlier batches, are left out.
    The key's columns must not be null.
    """
    ts, rest = order[0], list(order[1:])
    timed = with_time(marks, ts)
    fields = {f.name: f.dataType.simpleString() for f in timed.schema.fields}
    out = [*[f"`__key{i}` {fields[c]}" for i, c in enumerate(by)], *[f"`__{c}` array<{fields[c]}>" for c in rest]]
    out = ", ".join([*out, "__start_at array<long>", "__end_at array<long>"])
    lifetime = None if lifetime_ms is None else lifetime_ms * 1000
    packing = Packing(by, rest, ("kind",))
    marks_of = packing.pack(timed, delay).groupBy(*by)
    paired = marks_of.transformWithState(OpenMarks(by, rest, lifetime, packing), out, "Append", "EventTime")
    lists = [F.col(f"__{c}").alias(c) for c in (*rest, "start_at", "end_at")]
    keys = [F.col(f"__key{i}").alias(c) for i, c in enumerate(by)]
    return paired.select(*keys, F.inline(F.arrays_zip(*lists))).select(
        *by,
        *rest,
        from_micros("start_at").alias("start_ts"),
        from_micros("end_at").alias("end_ts"),
        ((F.col("end_at") - F.col("start_at")) / 1000.0).alias("duration_ms"),
    )
