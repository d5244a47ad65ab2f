"""When waiting events are sent: ten of them, five seconds, or at once (Q14)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from signalloom.limits import CLIENT_BATCH, FLUSH_MS
from signalloom.streaming.state import AT, CLOCK, from_micros, in_order, milliseconds, with_clock

FULL, URGENT, TIMER = "full", "urgent", "timer"
_URGENT = "__urgent"


class FlushBuffer(StatefulProcessor):
    """Events of a key that wait; the clock ticks at multiples of the interval."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], held: T.StructType, size: int, interval: int):
        self._keys, self._order, self._schema = tuple(keys), tuple(order), held
        self._size, self._interval = size, interval

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getListState("held", self._schema)
        self._count = handle.getValueState("count", "batches long, tick long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        batches, tick = self._count.get() if self._count.exists() else (0, None)
        held = [tuple(r) for r in self._held.get()] if self._held.exists() else []
        if held:
            self._handle.deleteTimer(self._end(tick))
        for at, urgent, *values in in_order(rows, self._order, (_URGENT, *self._schema.names)):
            now = at // self._interval
            if held and now > tick:
                batches += 1
                yield from self._send(key, held, batches, TIMER, (tick + 1) * self._interval)
                held = []
            tick = now if tick is None else max(tick, now)
            held.append(tuple(values))
            if len(held) >= self._size or urgent:
                batches += 1
                yield from self._send(key, held, batches, FULL if len(held) >= self._size else URGENT, at)
                held = []
        self._count.update((batches, tick))
        if held:
            self._held.put(held)
            self._handle.registerTimer(self._end(tick))
        else:
            self._held.clear()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        batches, tick = self._count.get()
        held = [tuple(r) for r in self._held.get()]
        self._held.clear()
        self._count.update((batches + 1, tick))
        yield from self._send(key, held, batches + 1, TIMER, (tick + 1) * self._interval)

    def _end(self, tick: int) -> int:
        return milliseconds((tick + 1) * self._interval - 1)

    def _send(self, key: Any, held: list[tuple], number: int, reason: str, at: int) -> Iterator[Row]:
        for pos, values in enumerate(held):
            yield Row(**dict(zip(self._keys, key)), **dict(zip(self._schema.names, values)), batch_no=number, pos=pos, reason=reason, flushed_micros=at)


def stream_flushes(
    events: DataFrame,
    by: Sequence[str],
    order: Sequence[str] = ("ts", "event_id"),
    columns: Sequence[str] = (),
    urgent: Column | None = None,
    size: int = CLIENT_BATCH,
    interval_ms: int = FLUSH_MS,
    delay: str = "1 minute",
) -> DataFrame:
    """Q14: every event with the batch it is sent in, when that is sent.

    A key's events wait until ``size`` of them are there (``reason`` full), an
    ``urgent`` one arrives (urgent), or the clock ticks (timer); ticks are the
    multiples of ``interval_ms``, and an event on a tick belongs to the time after
    it.  Adds ``batch_no`` (from 1 per key), ``pos`` (from 0), ``reason`` and
    ``flushed_at`` to the columns ``by``, the rest of ``order`` and ``columns``.

    The state of a key is its waiting events, fewer than ``size``, two numbers
    and a timer; the events of a batch are sorted on disk where they are many.  Order, lateness and null keys are as in ``stream_pairs``; an
    event that is late but in time joins the batch that waits.
    """
    ts, rest = order[0], list(order[1:])
    flag = F.coalesce(urgent, F.lit(False)) if urgent is not None else F.lit(False)
    timed = with_clock(events, ts, delay).withColumn(_URGENT, flag)
    names = list(dict.fromkeys([*rest, *columns]))
    held = T.StructType([timed.schema[c] for c in names])
    timed = timed.select(*dict.fromkeys([*by, *rest, *names, _URGENT, AT, CLOCK]))  # rows are taken apart value by value
    out = T.StructType([*[timed.schema[c] for c in (*by, *names)]])
    out = out.add("batch_no", T.LongType()).add("pos", T.IntegerType()).add("reason", T.StringType()).add("flushed_micros", T.LongType())
    buffer = FlushBuffer(by, rest, held, size, interval_ms * 1000)
    sent = timed.groupBy(*by).transformWithState(buffer, out, "Append", "EventTime")
    return sent.withColumn("flushed_at", from_micros("flushed_micros")).drop("flushed_micros")
