"""Backup decisions, keys and runs of a fleet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.hashing import jitter_minutes, key_fingerprint, valid_key
from signalloom.limits import MIN_RETRY_MINUTES, WINDOW_MINUTES
from signalloom.operators.ordered import HOT_ROWS, as_of, with_earlier_max
from signalloom.sources.scratch import materialize

# Columns a decision needs, beside the key.
POLICY_COLUMNS = ("enabled", "interval_hours", "preferred_hour_utc", "run_now_at")
STATE_COLUMNS = ("last_success_at", "last_attempt_at", "handled_run_now_at")


def _minutes(since: Column, now: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", since, now) / 60_000_000


def _readable(df: DataFrame, column: str) -> Column:
    """A time column, or text where it holds a time."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(column).cast("timestamp_ntz")
    return F.col(column).cast("timestamp_ntz")


def backup_due(df: DataFrame, now: Column, seed: str = "api_key") -> DataFrame:
    """B1: adds ``run``, ``trigger`` and ``reason`` for each project.

    ``df`` is policy joined with state (``join_state``); it must have all
    columns of both.  A null ``enabled`` means there is no policy.  The window
    of a late preferred hour ends at midnight.  A time that cannot be read is no
    reason to wait: the backup runs.
    """
    if missing := {*POLICY_COLUMNS, *STATE_COLUMNS, seed} - set(df.columns):
        raise ValueError(f"columns missing for a decision: {sorted(missing)}")
    now = now.cast("timestamp_ntz")
    state = {c: F.col(c) for c in STATE_COLUMNS}
    times = {c: _readable(df, c) for c in ("last_success_at", "last_attempt_at")}
    since_success = _minutes(times["last_success_at"], now)
    interval = F.col("interval_hours") * 60
    start = F.col("preferred_hour_utc") * 60 + jitter_minutes(seed)
    minute = F.hour(now) * 60 + F.minute(now)
    in_window = (minute >= start) & (minute < start + WINDOW_MINUTES)
    overdue = since_success >= 2 * interval
    # null-safe: a marker that was never handled differs from any marker
    unseen = F.col("run_now_at").isNotNull() & (F.col("run_now_at") != "") & ~F.col("run_now_at").eqNullSafe(
        state["handled_run_now_at"]
    )
    recent = _minutes(times["last_attempt_at"], now) < MIN_RETRY_MINUTES
    rule = (
        F.when(F.col("enabled").isNull(), "no policy")
        .when(~F.col("enabled"), "backups are off")
        .when(unseen, "requested by hand")
        .when(F.coalesce(recent, F.lit(False)), "last attempt too recent")
        .when(state["last_success_at"].isNull(), "no copy yet")
        .when(since_success < interval, "interval not over")
        .when((F.col("interval_hours") >= 24) & ~in_window & ~overdue, "outside the preferred window")
        .otherwise("interval over")
    )
    return df.withColumn("reason", rule).withColumns(
        {
            "run": F.col("reason").isin("requested by hand", "no copy yet", "interval over"),
            "trigger": F.when(F.col("reason") == "requested by hand", "MANUAL").when(
                F.col("reason").isin("no copy yet", "interval over"), "SCHEDULED"
            ),
        }
    )


def join_state(policy: DataFrame, state: DataFrame, key: str = "project_id") -> DataFrame:
    """Policies with their state; projects without state keep nulls."""
    return policy.join(state, key, "left")


def check_keys(df: DataFrame, key: str = "key_hex", expected: str = "expected_fingerprint") -> DataFrame:
    """Adds ``key_ok``, ``fingerprint`` and ``fingerprint_warning``.

    A fingerprint that differs from the policy's is a warning only: the key
    may have been changed on purpose.
    """
    mine = key_fingerprint(key)
    warn = F.coalesce((F.col(expected) != "") & (mine != F.col(expected)), F.lit(False))
    return df.withColumns({"key_ok": valid_key(key), "fingerprint": mine, "fingerprint_warning": warn})


def run_ledger(events: DataFrame, by: str = "project_id") -> DataFrame:
    """One row per run from its events.

    Input ``project_id, run_id, ts, kind, status, outcome, size_bytes,
    checksum, error``; ``kind`` is start (``status`` 409: another run is
    active, 403: off), heartbeat or final.  The first accepted final report
    counts.  A run without one is RUNNING; one that was never started
    successfully is REFUSED.
    """
    start = F.col("kind") == "start"
    accepted = start & F.coalesce(F.col("status").between(200, 299), F.lit(False))
    final = F.col("kind") == "final"
    report = F.struct("outcome", "size_bytes", "checksum", "error", F.col("ts").alias("at"))
    ledger = events.groupBy(by, "run_id").agg(
        F.min(F.when(accepted, F.col("ts"))).alias("started_at"),
        F.max(F.when(F.col("kind") == "heartbeat", F.col("ts"))).alias("last_heartbeat"),
        F.min_by(report, F.when(final, F.struct("ts", "outcome"))).alias("__report"),
        F.count_if(final).alias("final_reports"),
        F.max(F.when(start & ~accepted, F.col("status"))).alias("refused_status"),
    )
    never = F.col("started_at").isNull()
    return ledger.select(
        by,
        "run_id",
        "started_at",
        "last_heartbeat",
        "final_reports",
        F.when(never, "REFUSED").otherwise(F.coalesce("__report.outcome", F.lit("RUNNING"))).alias("run_status"),
        F.when(never, F.col("refused_status")).alias("refused_status"),
        F.when(~never, F.col("__report.at")).alias("finished_at"),
        F.when(~never, F.col("__report.size_bytes")).alias("size_bytes"),
        F.when(~never, F.col("__report.checksum")).alias("checksum"),
        F.when(~never, F.col("__report.error")).alias("error"),
    )


def state_from_ledger(ledger: DataFrame, by: str = "project_id") -> DataFrame:
    """State after the runs of a ledger: a start stamps the attempt, an upload the success."""
    return ledger.groupBy(by).agg(
        F.max("started_at").alias("last_attempt_at"),
        F.max(F.when(F.col("run_status") == "UPLOADED", F.col("finished_at"))).alias("last_success_at"),
    )


def overlapping_runs(ledger: DataFrame, by: str = "project_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Accepted runs of a project that started before an earlier one had ended."""
    end = F.coalesce("finished_at", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"))
    started = ledger.filter(F.col("started_at").isNotNull())
    busy = with_earlier_max(started, by, ("started_at", "run_id"), end, "__busy_until", hot_rows=hot_rows)
    return busy.filter(F.col("started_at") < F.col("__busy_until")).drop("__busy_until")


def _negated(at: str) -> Column:
    return -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(at))


def admit_runs(
    requests: DataFrame,
    by: str = "project_id",
    run: str = "run_id",
    start: str = "requested_at",
    until: str = "busy_until",
    hot_rows: int | None = None,
) -> DataFrame:
    """Adds ``start_status`` (201, 409 or 400) and ``blocked_by`` to requests to start a run.

    A project has one run at a time: a request is accepted if the run accepted
    last before it has ended by then, so each answer depends on all before it.
    The first request at or after the end of a run, if that were accepted, is its
    successor; the accepted runs of a project are those reached from its first
    request.  They are found by jumps whose length doubles each round, so a chain
    of n runs takes log n rounds, each a join on (project, time), which is unique.

    Of requests at one moment the smallest ``run`` goes first.  A run lasts a
    microsecond at least; one without an end is never over.  A request that is
    stored twice is one.  Requests without a project or time get 400.
    """
    forever = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    begin = F.col(start).cast("timestamp_ntz")
    least = F.timestamp_add("MICROSECOND", F.lit(1), begin)
    end = F.greatest(F.coalesce(F.col(until).cast("timestamp_ntz"), forever), least)
    timed = requests.where(F.col(by).isNotNull() & F.col(start).isNotNull()).select(F.col(by).alias("__k"), begin.alias("__t"), F.col(run).alias("__run"), end.alias("__end"))
    # of one moment only the first can be accepted
    first = timed.groupBy("__k", "__t").agg(F.min(F.struct("__run", "__end")).alias("__r"))
    nodes = materialize(first.select("__k", "__t", "__r.__run", "__r.__end"), "requests")
    # the successor is the last request at or before the end when time runs backwards
    here = nodes.select("__k", "__t", _negated("__end").alias("__to"))
    there = nodes.select("__k", F.col("__t").alias("__next"), _negated("__t").alias("__from"))
    jumps = materialize(as_of(here, there, "__k", ("__to", "__from"), ["__next"], hot_rows).select("__k", "__t", "__next").where("__next is not null"), "jumps")
    reached = materialize(nodes.groupBy("__k").agg(F.min("__t").alias("__t")), "reached")
    while not jumps.isEmpty():
        # all runs so far are the first ones of their chain; a jump from each gives as many more
        further = reached.join(jumps, ["__k", "__t"]).select("__k", F.col("__next").alias("__t"))
        reached = materialize(reached.unionByName(further), "reached")
        onward = jumps.select("__k", F.col("__t").alias("__next"), F.col("__next").alias("__then"))
        jumps = materialize(jumps.join(onward, ["__k", "__next"]).select("__k", "__t", F.col("__then").alias("__next")), "jumps")
    accepted = materialize(nodes.join(reached, ["__k", "__t"]), "accepted")
    asked = requests.withColumns({"__k": F.col(by), "__t": begin})
    marks = accepted.select("__k", F.col("__t").alias("__since"), F.col("__run").alias("__holder"))
    judged = as_of(asked, marks, "__k", ("__t", "__since"), ["__since", "__holder"], hot_rows)
    own = F.col("__since").eqNullSafe(F.col("__t")) & F.col("__holder").eqNullSafe(F.col(run))
    usable = F.col(by).isNotNull() & F.col(start).isNotNull()
    return judged.select(
        *requests.columns,
        F.when(~usable, 400).when(own, 201).otherwise(409).alias("start_status"),
        F.when(usable & ~own, F.col("__holder")).alias("blocked_by"),
    )
