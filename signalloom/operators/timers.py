"""Timer marks, timer events and measured calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.redact import scrub_string
from signalloom.functions.text import truncate_text
from signalloom.operators.nested import scrub_column
from signalloom.operators.ordered import HOT_ROWS, with_previous


def pair_timers(
    marks: DataFrame,
    by: Sequence[str] = ("client", "name"),
    order: Sequence[str] = ("ts", "mark_id"),
    slice_by: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """A stop closes the open start of its name; a later start replaces an open one.

    A pair is therefore exactly a stop whose previous mark of the same key is
    a start.  Output: the keys, ``start_ts``, ``end_ts``, the columns of the
    stop's order and ``duration_ms``.
    """
    ts = order[0]
    rows = with_previous(marks, by, order, {"kind": "__kind", ts: "__start"}, slice_by, hot_rows)
    micros = F.timestamp_diff("MICROSECOND", F.col("__start"), F.col(ts))
    return rows.filter((F.col("kind") == "stop") & (F.col("__kind") == "start")).select(
        *by,
        *order[1:],
        F.col("__start").alias("start_ts"),
        F.col(ts).alias("end_ts"),
        (micros / 1000.0).alias("duration_ms"),
    )


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = 10**digits
    return F.floor(c * scale + 0.5) / scale


def timer_events(pairs: DataFrame, metadata: str | None = None) -> DataFrame:
    """A debug event of type ``performance`` per pair.

    ``metadata`` names a ``map<string,string>`` column; its entries follow the
    name in ``data`` and win over it.
    """
    name = F.create_map(F.lit("name"), F.col("name"))
    data = name
    if metadata:
        extra = F.coalesce(F.col(metadata), F.create_map().cast("map<string,string>"))
        own = F.map_filter(name, lambda k, _v: ~F.map_contains_key(extra, k))
        data = F.map_concat(own, extra)
    performance = F.struct(
        round_half_up("duration_ms").alias("duration"),
        F.col("start_ts").alias("startTime"),
        F.col("end_ts").alias("endTime"),
    )
    return pairs.select(
        "*",
        F.lit("debug").alias("type"),
        F.lit("performance").alias("debug_type"),
        F.to_json(data).alias("data"),
        performance.alias("performance"),
    )


def measure_outcomes(calls: DataFrame, metadata: str | None = None) -> DataFrame:
    """Measured calls ``name, start_ts, end_ts, duration_ms, error_message``, and ``stack`` if there is one.

    A call that failed gives an error event and no timer event.  Its message and
    stack are redacted; the raw ones do not leave.  ``metadata`` names a
    ``map<string,string>`` column: its entries, redacted, come into the metadata
    of an error (where ``duration`` is the measured one) and the data of a timer event.
    """
    kept = [c for c in calls.columns if c not in ("error_message", "stack", metadata)]
    if metadata:
        calls = calls.withColumn(metadata, scrub_column(F.col(metadata), calls.schema[metadata].dataType))
    failed = calls.filter(F.col("error_message").isNotNull())
    message = F.concat(
        F.lit('Performance measurement "'), F.col("name"), F.lit('" failed: '), F.col("error_message")
    )
    about = F.to_json(F.struct(F.col("duration_ms").alias("duration")))
    if metadata:
        given = F.map_filter(F.coalesce(F.col(metadata), F.create_map().cast("map<string,string>")), lambda k, _v: k != "duration")
        about = F.to_json(F.map_concat(given, F.create_map(F.lit("duration"), F.col("duration_ms").cast("string"))))
    stack = truncate_text(scrub_string("stack")) if "stack" in calls.columns else F.lit(None).cast("string")
    errors = failed.select(
        *kept,
        F.lit("error").alias("type"),
        F.lit("RUNTIME").alias("event_type"),
        F.lit("MEDIUM").alias("severity"),
        truncate_text(scrub_string(message)).alias("message"),
        stack.alias("stack"),
        about.alias("metadata"),
        F.lit(None).cast("string").alias("data"),
        F.lit(None).cast("double").alias("duration"),
    )
    timed = timer_events(calls.filter(F.col("error_message").isNull()), metadata).select(
        *kept,
        "type",
        F.col("debug_type").alias("event_type"),
        F.lit(None).cast("string").alias("severity"),
        F.lit(None).cast("string").alias("message"),
        F.lit(None).cast("string").alias("stack"),
        F.lit(None).cast("string").alias("metadata"),
        "data",
        F.col("performance.duration").alias("duration"),
    )
    return errors.unionByName(timed)
