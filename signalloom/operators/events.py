"""Normalising, filtering, sampling and enriching events.

Event tables are wide: one row per event, payload fields as columns.  All of
these are projections and filters, so a chain of them is one stage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom import __version__
from signalloom.functions.hashing import unit_interval
from signalloom.functions.redact import scrub_string
from signalloom.functions.text import filled, iso_time, merge_maps, stack_or_summary, truncate_text
from signalloom.limits import CONSOLE_LEVELS, DEFAULT_SOURCE, LOG_LEVELS
from signalloom.operators.nested import scrub_column, scrub_json
from signalloom.operators.sizing import maybe_broadcast
from signalloom.schemas import EVENT


def _has(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _now(now: Column | None) -> Column:
    return iso_time(now if now is not None else F.current_timestamp())


def _scrub_metadata(df: DataFrame, name: str) -> dict[str, Column]:
    """Redacted metadata, whatever form the column has; nothing if there is none."""
    if name not in df.columns:
        return {}
    t = df.schema[name].dataType
    return {name: scrub_json(name) if isinstance(t, T.StringType) else scrub_column(F.col(name), t)}


def normalize_log(
    df: DataFrame, default_source: str = DEFAULT_SOURCE, metadata: str = "metadata", now: Column | None = None
) -> DataFrame:
    """Defaults for level, source and time; message and metadata redacted.

    Missing and empty values both take the default.  A bare string is a row
    with a message only.
    """
    return df.withColumns(
        {
            "level": filled(_has(df, "level"), "INFO"),
            "source": filled(_has(df, "source"), default_source),
            "message": scrub_string("message"),
            "timestamp": filled(_has(df, "timestamp"), _now(now)),
            **_scrub_metadata(df, metadata),
        }
    )


def normalize_error(
    df: DataFrame,
    metadata: str = "metadata",
    exception: Column | None = None,
    name: str = "name",
    now: Column | None = None,
) -> DataFrame:
    """Defaults for type, severity and time; message and stack redacted, then cut.

    Rows for which ``exception`` holds were thrown objects: type RUNTIME,
    severity MEDIUM, the stack or else ``name: message``, and ``{name}`` as
    metadata.
    """
    thrown = F.coalesce(exception, F.lit(False)) if exception is not None else F.lit(False)
    kind, stack, severity = _has(df, "error_type"), _has(df, "stack"), _has(df, "severity")
    cols = {
        "error_type": F.when(thrown, "RUNTIME").otherwise(filled(kind, "UNKNOWN")),
        "severity": F.when(thrown, "MEDIUM").otherwise(filled(severity, "MEDIUM")),
        "message": truncate_text(scrub_string("message")),
        "timestamp": filled(_has(df, "timestamp"), _now(now)),
    }
    if exception is not None:
        stack = F.when(thrown, stack_or_summary(stack, F.col(name), F.col("message"))).otherwise(stack)
    cols["stack"] = F.when(stack != "", truncate_text(scrub_string(stack)))
    scrubbed = _scrub_metadata(df, metadata)
    if exception is not None:
        own = F.to_json(F.struct(scrub_string(F.col(name)).alias("name")))
        scrubbed = {metadata: F.when(thrown, own).otherwise(scrubbed.get(metadata, F.lit(None).cast("string")))}
    return df.withColumns({**cols, **scrubbed})


def normalize_debug(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Defaults for type and time.  Redaction happens at the sink."""
    return df.withColumns(
        {
            "debug_type": filled(_has(df, "debug_type"), "unknown"),
            "timestamp": filled(_has(df, "timestamp"), _now(now)),
        }
    )


def normalize_security(df: DataFrame) -> DataFrame:
    """Default for type.  Security events carry no time of their own."""
    return df.withColumns({"security_type": filled(_has(df, "security_type"), "SUSPICIOUS_ACTIVITY")})


def with_level(df: DataFrame, level: str) -> DataFrame:
    """P5: the per-level shorthands."""
    if level not in LOG_LEVELS:
        raise ValueError(f"unknown level {level!r}")
    return df.withColumn("level", F.lit(level))


def level_priority(level: Column | str) -> Column:
    """0 for DEBUG up to 4 for FATAL; unknown and missing levels count as 0."""
    level = F.col(level) if isinstance(level, str) else level
    out = F.when(level == LOG_LEVELS[1], 1)
    for i, name in enumerate(LOG_LEVELS[2:], start=2):
        out = out.when(level == name, i)
    return out.otherwise(0)


def filter_min_level(df: DataFrame, minimum: str, kind: str | None = "type") -> DataFrame:
    """Logs below the minimum level go; other kinds of events stay.

    A missing level is INFO here, because the default is applied before the
    test.  ``kind=None`` if the table holds logs only.
    """
    floor = LOG_LEVELS.index(minimum) if minimum in LOG_LEVELS else 0
    keep = level_priority(filled("level", "INFO")) >= floor
    return df.filter(keep if kind is None else (F.col(kind) != "log") | keep)


def sample_events(df: DataFrame, rate: float, seed: int | None = None, by: str | Column | None = None) -> DataFrame:
    """Keep each event with probability ``rate``.

    With ``by`` the decision is a function of that key, so re-runs and other
    engines keep the same events.
    """
    if rate >= 1:
        return df
    if rate <= 0:
        return df.limit(0)
    draw = unit_interval(by) if by is not None else F.rand(seed) if seed is not None else F.rand()
    return df.filter(draw < rate)


def merge_tags(tags: Column | str, global_context: Column | str | None) -> Column:
    """Tags and global context in one map; the global context wins."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    if global_context is None:
        return tags
    extra = F.col(global_context) if isinstance(global_context, str) else global_context
    return F.when(extra.isNull(), tags).when(tags.isNull(), extra).otherwise(merge_maps(tags, extra))


def _tag_map(values: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def enrich_context(
    df: DataFrame,
    context: Mapping[str, str | int] | None = None,
    tags: Mapping[str, str] | Column | None = None,
    global_context: Mapping[str, str] | Column | None = None,
    hosts: DataFrame | None = None,
    host_key: str = "host_id",
    now: Column | None = None,
) -> DataFrame:
    """Adds ``_meta`` with version, capture time and context.

    ``context`` holds fields that are the same for all rows; ``hosts`` (one
    row per host, key ``host_key``) adds per-host fields by a join, which is
    broadcast if the table proves small.
    """
    fields = [F.lit(v).alias(k) for k, v in (context or {}).items()]
    host_columns: list[str] = []
    if hosts is not None:
        host_columns = [c for c in hosts.columns if c != host_key]
        side = hosts.select(host_key, *[F.col(c).alias(f"__h_{c}") for c in host_columns])
        df = df.join(maybe_broadcast(side), host_key, "left")
        fields += [F.col(f"__h_{c}").alias(c) for c in host_columns]
    tags = _tag_map(tags) if isinstance(tags, Mapping) else tags
    extra = _tag_map(global_context) if isinstance(global_context, Mapping) else global_context
    if tags is not None or extra is not None:
        own = tags if tags is not None else F.lit(None).cast("map<string,string>")
        fields.append(merge_tags(own, extra).alias("tags"))
    meta = F.struct(
        F.lit(__version__).alias("sdkVersion"),
        _now(now).alias("timestamp"),
        (F.struct(*fields) if fields else F.lit(None).cast("struct<environment:string>")).alias("context"),
    )
    return df.withColumn("_meta", meta).drop(*[f"__h_{c}" for c in host_columns])


def user_context(df: DataFrame, user: str = "user") -> DataFrame:
    """P10: e-mail masked, then the whole user object redacted, under ``user``."""
    t = df.schema[user].dataType
    if isinstance(t, T.StringType):
        return df.withColumn(user, scrub_json(user))
    return df.withColumn(user, scrub_column(F.col(user), t))


def before_send(df: DataFrame, hook: Callable[[dict], dict | bool | None], schema: T.StructType | None = None) -> DataFrame:
    """A row-level hook that may replace an event or drop it (``False``).

    If the hook raises, the event goes on unmodified.  Prefer ``df.transform``
    with column expressions: this one leaves the JVM.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for row in batch.to_dict("records"):
                try:
                    result = hook(dict(row))
                except Exception:  # noqa: BLE001 - the hook is foreign code
                    result = row
                if result is not False:
                    kept.append(result)
            yield pd.DataFrame(kept, columns=out.names)

    out = schema or df.schema
    return df.mapInPandas(run, out)


class StageChain:
    """Ordered stages, each ``DataFrame -> DataFrame``; dropping is filtering.

    Stages after one that drops an event do not see that event, and an error
    in a stage is not caught.
    """

    def __init__(self, *stages: Callable[[DataFrame], DataFrame]):
        self._stages = list(stages)

    def use(self, stage: Callable[[DataFrame], DataFrame]) -> StageChain:
        self._stages.append(stage)
        return self

    def run(self, df: DataFrame) -> DataFrame:
        for stage in self._stages:
            df = df.transform(stage)
        return df

    @property
    def count(self) -> int:
        return len(self._stages)

    def clear(self) -> None:
        self._stages.clear()


def console_level(level: Column | str) -> Column:
    level = F.col(level) if isinstance(level, str) else level
    out = None
    for name, mapped in CONSOLE_LEVELS.items():
        out = F.when(level == name, mapped) if out is None else out.when(level == name, mapped)
    return out.otherwise("INFO")


def console_to_events(
    df: DataFrame, args: str = "args", level: str = "console_level", json_args: bool = False
) -> DataFrame:
    """A console call as a log event.

    ``args`` is an array of strings.  With ``json_args`` each element is JSON
    text of an object and is redacted as such.  The joined message is redacted
    as a whole once more, for secrets that only the joined text shows.
    """
    if json_args:
        # one Arrow call per row on the whole array, then the elements as text again
        cleaned = F.from_json(scrub_json(F.to_json(args)), "array<string>")
    else:
        cleaned = F.transform(F.col(args), lambda a: scrub_string(a))
    message = scrub_string(F.concat_ws(" ", cleaned))
    meta = F.to_json(F.struct(F.lit(True).alias("autoCapture"), F.col(level).alias("consoleLevel")))
    return df.select(
        *[c for c in df.columns if c != args],
        F.lit("log").alias("type"),
        console_level(level).alias("level"),
        message.alias("message"),
        meta.alias("metadata"),
    )


def crash_to_events(df: DataFrame, runtime: str, kind: str) -> DataFrame:
    """Uncaught errors and unhandled rejections as error events.

    Input ``message, stack`` (and ``name``; ``filename, lineno, colno`` in
    browsers).  ``runtime`` is browser or node, ``kind`` error or rejection.
    """
    if runtime not in ("browser", "node") or kind not in ("error", "rejection"):
        raise ValueError(f"no crash records for {runtime!r}, {kind!r}")
    auto = F.lit(True).alias("autoCapture")
    stack = F.when(F.col("stack") != "", F.col("stack"))
    if kind == "rejection":
        # an empty message is kept: only a missing reason has a stand-in
        text = F.concat(F.lit("Unhandled Promise Rejection: "), F.coalesce("message", F.lit("Unhandled rejection")))
        severity, meta = "HIGH", F.struct(auto, F.lit("unhandledRejection").alias("type"))
    elif runtime == "browser":
        text = filled("message", "Uncaught error")
        place = F.concat_ws(":", "filename", F.col("lineno").cast("string"), F.col("colno").cast("string"))
        stack = F.coalesce(stack, place)
        severity = "HIGH"
        meta = F.struct(scrub_string("filename").alias("filename"), "lineno", "colno", auto)
    else:
        text = filled("message", "Uncaught exception")
        severity, meta = "CRITICAL", F.struct(scrub_string("name").alias("name"), auto)
    replaced = ("type", "error_type", "severity", "message", "stack", "metadata")
    return df.select(
        *[c for c in df.columns if c not in replaced],
        F.lit("error").alias("type"),
        F.lit("RUNTIME").alias("error_type"),
        F.lit(severity).alias("severity"),
        truncate_text(scrub_string(text)).alias("message"),
        truncate_text(scrub_string(stack)).alias("stack"),
        F.to_json(meta).alias("metadata"),
    )


def flag_immediate(df: DataFrame, kind: str = "type") -> DataFrame:
    """Adds ``immediate`` for events that must not wait for the batch."""
    k = F.col(kind)
    fatal = (k == "log") & (_has(df, "level") == "FATAL")
    critical = (k == "error") & (_has(df, "severity") == "CRITICAL")
    return df.withColumn("immediate", F.coalesce(fatal, F.lit(False)) | F.coalesce(critical, F.lit(False)) | (k == "security"))


def classify_status(status: Column | str, in_batch: Column | bool = False) -> Column:
    """What an HTTP status (null: no answer) means for the events sent."""
    s = F.col(status) if isinstance(status, str) else status
    batch = F.lit(in_batch) if isinstance(in_batch, bool) else in_batch
    return (
        F.when(s.between(200, 299), "ok")
        .when((s == 400) & batch, "split")
        .when(s.between(400, 499) & (s != 429), "permanent")
        .otherwise("retryable")
    )


def is_json_object(raw: Column | str) -> Column:
    raw = F.col(raw) if isinstance(raw, str) else raw
    # a map of strings parses from any object and from nothing else
    parsed = F.from_json(raw, "map<string,string>")
    return F.coalesce(raw.rlike(r"\A\s*\{") & parsed.isNotNull(), F.lit(False))


def filter_object_events(
    df: DataFrame, raw: str = "value", schema: T.StructType = EVENT
) -> tuple[DataFrame, DataFrame]:
    """V4: (events that are JSON objects, the rest), from JSON text.

    The parsed event comes as ``event``.
    """
    keep = is_json_object(raw)
    return df.filter(keep).withColumn("event", F.from_json(raw, schema)), df.filter(~keep)
