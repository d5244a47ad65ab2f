"""When micro-batches run (Q14)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from signalloom.limits import FLUSH_INTERVAL, SPOOL_TTL_HOURS
from signalloom.operators.delivery import drop_expired


def micro_batches(df: DataFrame, interval: str = FLUSH_INTERVAL) -> DataStreamWriter:
    """Q14: a writer that starts a batch every five seconds.

    The second condition of a flush, enough waiting events, belongs to the
    source: ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger`` there bounds a
    batch, and a batch that takes longer than the interval is followed by the
    next one at once.  ``available_now`` replaces the interval for catch-up runs.
    """
    return df.writeStream.trigger(processingTime=interval)


def available_now(writer: DataStreamWriter) -> DataStreamWriter:
    return writer.trigger(availableNow=True)


def drop_expired_stream(df: DataFrame, created: str = "created_at", ttl_hours: int = SPOOL_TTL_HOURS) -> DataFrame:
    """Q4 for streams: "now" is the time of the micro-batch, the same for all its rows."""
    return drop_expired(df, F.current_timestamp().cast("timestamp_ntz"), ttl_hours, created)


class FlushListener(StreamingQueryListener):
    """Callbacks of a delivery loop: rows of a finished batch, or the failure of the query."""

    def __init__(self, on_success: Callable[[int], None] | None = None, on_error: Callable[[str], None] | None = None):
        self._on_success, self._on_error = on_success, on_error

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        if self._on_success and event.progress.numInputRows:
            self._on_success(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        if self._on_error and event.exception:
            self._on_error(event.exception)
