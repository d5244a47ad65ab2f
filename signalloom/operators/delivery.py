"""Queues, batches and delivery bookkeeping (Q1-Q13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom import __version__
from signalloom.limits import (
    CLIENT_BATCH,
    FLUSH_MS,
    MAX_BODY_BYTES,
    MAX_RETRIES,
    QUEUE_CAPACITY,
    SPOOL_ITEM_CHARS,
    SPOOL_TOTAL_CHARS,
    SPOOL_TTL_HOURS,
)
from signalloom.operators.events import classify_status
from signalloom.operators.ordered import HOT_ROWS, Previous, SinceReset, Sum, keep_first, keep_within, number_rows, running
from signalloom.operators.sizing import maybe_broadcast
from signalloom.sources.scratch import materialize

ORDER = ("ts", "event_id")


def _list(by: str | Sequence[str] | None) -> list[str]:
    return [] if by is None else [by] if isinstance(by, str) else list(by)


def keep_latest(
    df: DataFrame, n: int = QUEUE_CAPACITY, by: str | Sequence[str] | None = None, order: Sequence[str] = ORDER
) -> DataFrame:
    """Q1: a bounded FIFO that was full drops its oldest rows; the newest ``n`` remain."""
    return keep_first(df, n, _list(by), order, latest=True)


def take_front(
    df: DataFrame, n: int, by: str | Sequence[str] | None = None, order: Sequence[str] = ORDER
) -> DataFrame:
    """Q2: the first ``n`` rows in queue order."""
    return keep_first(df, n, _list(by), order)


def requeue_front(
    queue: DataFrame,
    failed: DataFrame,
    n: int = QUEUE_CAPACITY,
    by: str | Sequence[str] | None = None,
    order: Sequence[str] = ORDER,
    now: Column | None = None,
) -> DataFrame:
    """Q3: failed rows go back to the front, one retry more; over capacity the newest go.

    Adds ``prio`` (0 for the rows put back), the leading part of the new order.
    """
    at = (now if now is not None else F.current_timestamp()).cast("timestamp_ntz")
    seen = F.col("last_attempt") if "last_attempt" in queue.columns else F.lit(None)
    waiting = queue.withColumns({"last_attempt": seen.cast("timestamp_ntz"), "prio": F.lit(1)})
    back = failed.withColumns({"retries": F.col("retries") + 1, "last_attempt": at, "prio": F.lit(0)})
    return take_front(back.unionByName(waiting), n, by, ("prio", *order))


def drop_expired(df: DataFrame, now: Column, ttl_hours: int = SPOOL_TTL_HOURS, created: str = "created_at") -> DataFrame:
    """Q4: rows younger than the time to live, strictly.

    The limit is computed from ``now``, so the comparison reaches the scan.
    """
    return df.filter(F.col(created) > now - F.expr(f"INTERVAL {ttl_hours} HOURS"))


def persist_budget(
    df: DataFrame,
    item: str | Column,
    by: str | Sequence[str] | None = None,
    order: Sequence[str] = ORDER,
    item_limit: int = SPOOL_ITEM_CHARS,
    total_limit: int = SPOOL_TOTAL_CHARS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Q5: skip items over the item limit, then stop where the total would pass the budget.

    Sizes are not negative, so "stop at the first that does not fit" keeps the
    rows of a key up to one place, which ``keep_within`` finds from sums per
    piece of the order; rows are sorted only in the piece where the budget ends.

    Items are read several times; materialise them if they are costly to compute.
    """
    size = F.char_length(F.col(item) if isinstance(item, str) else item).cast("long")
    return keep_within(df, _list(by), order, F.when(size <= item_limit, size), total_limit, hot_rows=hot_rows)


def assign_batches(
    df: DataFrame,
    by: str | Sequence[str],
    size: int = CLIENT_BATCH,
    order: Sequence[str] = ORDER,
    slice_by: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Q6: adds ``batch_no`` and ``pos`` (both from 0) in queue order per key.

    ``slice_by`` cuts a key of more than ``hot_rows`` rows into pieces; default:
    quantiles of the order (see ``operators.ordered``).  Rows without a place in
    the order come first.
    """
    n = F.col("__no") - 1
    return (
        number_rows(df, by, order, slice_by, "__no", hot_rows)
        .withColumns({"batch_no": F.floor(n / size), "pos": (n % size).cast("int")})
        .drop("__no")
    )


def flush_batches(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[str] = ORDER,
    urgent: Column | None = None,
    size: int = CLIENT_BATCH,
    interval_ms: int = FLUSH_MS,
    hot_rows: int | None = None,
) -> DataFrame:
    """Q14 over a table: the batch every event of a key was sent in, and why.

    Waiting events are sent when ``size`` of them are there (``reason`` full),
    when an ``urgent`` one arrives, or at the next multiple of ``interval_ms``
    (timer).  Every tick finds an empty queue after it, and every urgent event
    leaves one, so events between two of those go in tens.  Adds ``batch_no``
    (from 1), ``pos`` (from 0), ``reason`` and ``flushed_at``; ``order`` begins
    with a time and is total.  Events without a time are sent by no tick: they
    are the first, and go like those of one interval.
    """
    keys = _list(by)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = F.col(order[0]).cast("timestamp_ntz")
    tick = F.floor(F.timestamp_diff("MICROSECOND", epoch, at) / (interval_ms * 1000))
    flag = F.coalesce(urgent, F.lit(False)) if urgent is not None else F.lit(False)
    marked = df.withColumns({"__tick": tick, "__urgent": flag})
    # a new part begins with a tick and after an urgent event
    before = {"__before": Previous(F.struct("__tick", "__urgent"))}
    parts = running(marked, keys, order, before, hot_rows)
    begins = F.col("__before").isNull() | F.col("__before.__urgent") | ~F.col("__before.__tick").eqNullSafe(F.col("__tick"))
    numbered = running(parts.withColumn("__begins", begins), keys, order, {"__in": SinceReset(F.col("__begins"))}, hot_rows)
    pos = (F.col("__in") % size).cast("int")
    tens = numbered.withColumns({"pos": pos, "__new": pos == 0})
    counted = running(tens, keys, order, {"batch_no": Sum(F.col("__new").cast("long"))}, hot_rows)
    batch = Window.partitionBy(*keys, "batch_no")
    sent = counted.withColumns(
        {
            "__n": F.count(F.lit(1)).over(batch),
            "__forced": F.bool_or("__urgent").over(batch),
            "__last": F.max(at).over(batch),
        }
    )
    full = F.col("__n") == size
    ends = F.timestamp_add("MICROSECOND", (F.col("__tick") + 1) * interval_ms * 1000, epoch)
    return sent.select(
        *df.columns,
        "batch_no",
        "pos",
        F.when(full, "full").when(F.col("__forced"), "urgent").otherwise("timer").alias("reason"),
        F.when(full | F.col("__forced"), F.col("__last")).otherwise(ends).alias("flushed_at"),
    )


def batch_sizes(df: DataFrame, body: str = "body", batch: str = "batch_id") -> DataFrame:
    """Q7: ``n_events`` and ``batch_bytes`` of every batch.

    A batch is ``{"events":[...]}``, a single event travels bare.
    """
    n = F.col("n_events")
    sums = df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.octet_length(body).cast("long")).alias("__bytes")
    )
    envelope = F.when(n == 1, 0).otherwise(F.lit(len('{"events":[]}')) + n - 1)
    return sums.select(batch, "n_events", (F.col("__bytes") + envelope).alias("batch_bytes"))


def batch_size_gate(
    df: DataFrame, body: str = "body", batch: str = "batch_id", split_oversized: bool = True
) -> DataFrame:
    """Q7: adds ``gate`` (send / split / failed) to every event.

    Oversized batches are sent event by event; ``split_oversized=False`` fails
    them without a retry.  An event that is too large alone always fails.  Only
    sizes are shuffled: the events are joined with the oversized batches,
    which are few, and not with all totals.
    """
    limit = MAX_BODY_BYTES["fetch"]
    over = batch_sizes(df, body, batch).filter(F.col("batch_bytes") > limit)
    over = materialize(over.select(F.col(batch).alias("__batch"), F.col("n_events").alias("__n")), "oversized")
    joined = df.join(maybe_broadcast(over), F.col(batch) == F.col("__batch"), "left")
    alone = F.when((F.col("__n") > 1) & (F.octet_length(body) <= limit), "split").otherwise("failed")
    gate = F.when(F.col("__n").isNull(), "send").otherwise(alone if split_oversized else F.lit("failed"))
    return joined.withColumn("gate", gate).drop("__batch", "__n")


def join_acks(events: DataFrame, acks: DataFrame, batch: str = "batch_id", pos: str = "pos") -> DataFrame:
    """Q8: acknowledgement i of a batch belongs to its event i.

    Adds ``success``, ``ack_id`` and ``ack_type``.  An answered batch makes all
    its events successes, also those without an acknowledgement.  One that was
    delivered twice counts once: of several the smallest id is taken.
    """
    ok = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    once = acks.groupBy(batch, pos).agg(F.min(F.struct("ack_id", "ack_type")).alias("__ack"))
    side = once.select(
        F.col(batch).alias("__b"),
        F.col(pos).alias("__p"),
        F.col("__ack.ack_id").alias("__id"),
        F.col("__ack.ack_type").alias("__ty"),
    )
    joined = events.join(side, (F.col(batch) == F.col("__b")) & (F.col(pos) == F.col("__p")), "left")
    named = ok & F.col("__id").isNotNull()
    return joined.select(
        *events.columns,
        ok.alias("success"),
        F.when(named, F.col("__id")).alias("ack_id"),
        F.when(named, F.col("__ty")).alias("ack_type"),
    )


def reconcile_delivery(
    results: DataFrame, max_retries: int = MAX_RETRIES, flush_failed: Column | None = None, cap_always: bool = True
) -> DataFrame:
    """Q9: adds ``outcome`` (delivered / retry / dropped) from ``success`` and ``retries``.

    ``flush_failed`` marks rows whose whole flush raised; with
    ``cap_always=False`` those are put back however often they were tried.
    """
    crashed = F.coalesce(flush_failed, F.lit(False)) if flush_failed is not None else F.lit(False)
    free = F.lit(False) if cap_always else crashed
    return results.withColumn(
        "outcome",
        F.when(F.col("success") & ~crashed, "delivered")
        .when(free | (F.col("retries") < max_retries), "retry")
        .otherwise("dropped"),
    )


def delivery_counts(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def split_rejected_batches(df: DataFrame, batch: str = "batch_id", pos: str = "pos") -> DataFrame:
    """Q10: what happens to the events of a batch after its answer.

    Adds ``next_step`` and ``send_id``: events of a batch answered with 400 are
    sent again alone (``resend_single``, each under its own id); any other
    failure fails every event with the message in ``error``.
    """
    kind = classify_status("status", in_batch=True)
    ids = F.col(batch).cast("string")
    message = F.coalesce(F.concat(F.lit("HTTP "), F.col("status").cast("string")), F.lit("no answer"))
    return df.select(
        "*",
        F.when(kind == "ok", "done").when(kind == "split", "resend_single").otherwise("failed").alias("next_step"),
        F.when(kind == "split", F.concat_ws("-", ids, F.col(pos).cast("string"))).otherwise(ids).alias("send_id"),
        F.when(kind.isin("permanent", "retryable"), message).alias("error"),
    )


def peek(queue: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Q12: all rows in queue order, none removed."""
    return queue.orderBy(*order)


def queue_sizes(queue: DataFrame, by: str | Sequence[str] | None = None) -> DataFrame:
    """Q12: ``size`` and ``is_empty``, per key or of the whole queue."""
    keys = _list(by)
    grouped = queue.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return grouped.withColumn("is_empty", F.col("size") == 0)


def drain(queue: DataFrame, order: Sequence[str] = ORDER) -> tuple[DataFrame, DataFrame]:
    """Q12: (everything in order, the empty queue)."""
    return peek(queue, order), clear(queue)


def clear(queue: DataFrame) -> DataFrame:
    return queue.limit(0)


def delivery_stats(reconciled: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Q13: one row of counters.

    ``total_flushes`` counts batches with at least one delivered event,
    ``total_errors`` dropped events, ``queue_size`` those to be tried again.
    """
    is_ = lambda o: F.col("outcome") == o
    return reconciled.agg(
        F.count_if(is_("retry")).alias("queue_size"),
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct(F.when(is_("delivered"), F.col(batch))).alias("total_flushes"),
        F.count_if(is_("dropped")).alias("total_errors"),
    ).withColumn("version", F.lit(__version__))
