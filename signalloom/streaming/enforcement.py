"""Continuous enforcement with a blocklist that is refreshed on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from signalloom.operators.blocklist import firewall_verdict, match_blocklist
from signalloom.streaming.triggers import micro_batches


def stream_match(
    requests: DataFrame,
    entries: Callable[[], DataFrame],
    sink: Callable[[DataFrame, int], None],
    mode: Callable[[], str | None] | str | None = "ENFORCE",
    ip: str = "ip",
    ts: str = "ts",
) -> DataStreamWriter:
    """verdicts for a stream of requests.

    ``entries`` (and ``mode``, if it is a function) is called for every
    micro-batch, so a list that was refreshed is used from the next batch on;
    its size is checked each time as in
    ``match_blocklist``.  ``sink`` gets the verdicts and the batch id and must
    be idempotent for a batch id, as batches are repeated after a failure.
    Set a checkpoint location on the writer.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        matched = match_blocklist(batch, entries(), ip, ts)
        in_force = mode() if callable(mode) else mode
        sink(firewall_verdict(matched, F.lit(in_force)), batch_id)

    return micro_batches(requests).foreachBatch(handle)
