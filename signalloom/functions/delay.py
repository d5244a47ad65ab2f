"""Q11: waiting times between attempts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.limits import POLL_BACKOFF_MAX_MS, POLL_MS, RETRY_BASE_MS, RETRY_MAX_MS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def next_attempt(
    attempt: Column | str,
    base: int = RETRY_BASE_MS,
    maximum: int = RETRY_MAX_MS,
    jitter: Column | None = None,
) -> Column:
    """least(base * 2**attempt + jitter * base, maximum) milliseconds.

    ``jitter`` is a number in [0, 1): ``F.rand()`` for a random wait,
    ``unit_interval(key)`` for a reproducible one, None for none.
    """
    grown = F.pow(F.lit(2.0), _col(attempt)) * base
    if jitter is not None:
        grown = grown + jitter * base
    return F.least(grown, F.lit(float(maximum)))


def next_poll(errors: Column | str, base: int = POLL_MS, maximum: int = POLL_BACKOFF_MAX_MS) -> Column:
    """The poller's wait: the base interval, doubled for every error in a row."""
    e = _col(errors)
    return F.when(e == 0, F.lit(float(base))).otherwise(next_attempt(e, base, maximum))


def retry_schedule(max_retries: Column | str, base: int = RETRY_BASE_MS, maximum: int = RETRY_MAX_MS) -> Column:
    """Waits before retry 1..n as an array (empty for n = 0)."""
    n = _col(max_retries)
    return F.when(
        n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: next_attempt(i, base, maximum))
    ).otherwise(F.array().cast("array<double>"))
