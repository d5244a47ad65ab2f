"""Sources, sinks and streams (S1-S10, F13, Q14 and the stream forms of Q4 and T1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions.net import client_ip, normalize_ip
from signalloom.limits import FLUSH_INTERVAL
from signalloom.plans.backup_queries import KEY, snapshot
from signalloom.plans.delivery_queries import _PAIRS_SQL, NOW as QUEUE_NOW
from signalloom.plans.firewall_queries import _MATCH
from signalloom.plans.redact_queries import sql_emails, sql_key_values
from signalloom.plans.views import VIEWS, table, view
from signalloom.operators.delivery import flush_batches
from signalloom.operators.snapshots import restore_artifacts
from signalloom.sources import artifacts as art
from signalloom.sources import backup_io, blocklist_io, events_io, spool
from signalloom.sources.scratch import scratch_path
from signalloom.streaming.enforcement import stream_match
from signalloom.streaming.flush import stream_flushes
from signalloom.streaming.timers import stream_pairs
from signalloom.streaming.triggers import available_now, drop_expired_stream, micro_batches


def _payload() -> Column:
    return F.struct(
        "type",
        F.struct(F.col("level"), F.col("message"), F.col("metadata_json").alias("metadata")).alias("data"),
        F.struct(F.lit("1").alias("sdkVersion"), F.col("event_id").cast("string").alias("batchId")).alias("_meta"),
    )


def _json_lines(s: SparkSession, d: str) -> str:
    """All events as JSON lines, every 50th broken off."""
    path = scratch_path(s, "events-json")
    line = F.to_json(_payload())
    broken = F.when(F.col("event_id") % 50 == 0, F.expr("substring(line, 1, 20)")).otherwise(F.col("line"))
    view(s, d, "telemetry").withColumn("line", line).select(broken.alias("value")).write.text(path)
    return path


def _read_back(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("_meta.batchId").cast("long").alias("event_id"),
        "type",
        F.col("data.message").alias("message"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )


def read_events(s: SparkSession, d: str) -> DataFrame:
    rows = _read_back(events_io.read_events(s, _json_lines(s, d)))
    return rows.filter(~F.col("corrupt")).drop("corrupt")


def stream_events(s: SparkSession, d: str) -> DataFrame:
    """The same files as a stream, with the flush trigger of delivery in catch-up mode."""
    out = scratch_path(s, "events-out")
    rows = _read_back(events_io.stream_events(s, _json_lines(s, d), max_files=4))
    writer = available_now(micro_batches(rows, FLUSH_INTERVAL)).format("parquet").option("path", out)
    writer.option("checkpointLocation", scratch_path(s, "checkpoint")).start().awaitTermination()
    return s.read.schema("event_id long, type string, message string, corrupt boolean").parquet(out).filter(
        ~F.col("corrupt")
    ).drop("corrupt")


def _envelopes(s: SparkSession, d: str) -> DataFrame:
    """Requests as they travel: batches of ten, but every batch of a multiple of seven as single events."""
    sent = view(s, d, "sent").select(
        "event_id",
        F.when(F.col("batch_id") % 7 == 0, -F.col("event_id")).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(F.col("batch_id") % 7 == 0, F.lit(0)).otherwise(F.col("pos")).alias("pos"),
        F.to_json(F.struct("event_id", "status")).alias("body"),
    )
    return events_io.write_batches(sent)


def exploded(s: SparkSession, d: str) -> DataFrame:
    requests = _envelopes(s, d).select("batch_id", F.col("body").alias("value"))
    return events_io.explode_batches(requests).select(
        "batch_id", "pos", F.get_json_object("event_json", "$.event_id").cast("long").alias("event_id")
    )


def blocklist_versions(s: SparkSession, d: str) -> DataFrame:
    """A version per event written and read; those without mode or entries are not usable."""
    path = scratch_path(s, "blocklist")
    user, n = F.col("user_id"), F.col("event_id")
    entry = F.struct(
        F.lit("IP").alias("type"),
        F.concat(F.lit("10.0.0."), (user % 256).cast("string")).alias("value"),
        F.when(n % 2 == 0, F.lit("2024-02-01T00:00:00Z")).otherwise(F.lit("soon")).alias("expiresAt"),
    )
    rows = table(s, d, "events").select(
        F.when(n % 3 > 0, F.lit("ENFORCE")).alias("mode"),
        F.when(n % 7 > 0, F.array(entry)).alias("entries"),
        (F.lit(1704067200000) + n).alias("fetchedAt"),
    )
    for half in (0, 1):
        blocklist_io.append_blocklist_snapshot(rows.filter(F.col("fetchedAt") % 2 == half), path)
    read = blocklist_io.read_blocklist_snapshots(s, path)
    return read.select("fetched_at", "mode", F.col("entries")[0]["value"].alias("value"), F.col("entries")[0]["expires_at"].alias("expires_at"))


def policies(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "policies")
    table(s, d, "events").select(
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("project_id"),
        (F.col("event_id") % 3 > 0).alias("enabled"),
        (F.col("event_id") % 48).cast("int").alias("intervalHours"),
        (F.col("event_id") % 24).cast("int").alias("preferredHourUtc"),
        F.lit(500).alias("maxSizeMb"),
        F.col("event_id").alias("fetchedAt"),
    ).write.json(path)
    return backup_io.read_backup_policy(s, path).select(
        "project_id", "enabled", "interval_hours", "preferred_hour_utc", "max_size_mb"
    )


def states(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "states")
    number = (F.col("c_custkey") % 2 == 0)
    line = F.concat(
        F.lit('{"project_id":"p'), F.col("c_custkey").cast("string"), F.lit('","lastSuccessAt":'),
        F.when(number, F.lit("17")).otherwise(F.concat(F.lit('"s'), F.col("c_custkey").cast("string"), F.lit('"'))),
        F.lit(',"lastAttemptAt":"a","other":1}'),
    )
    table(s, d, "customer").select(line.alias("value")).write.text(path)
    patch = table(s, d, "customer").filter("c_custkey % 3 = 0").select(
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("project_id"),
        F.when(F.col("c_custkey") % 9 > 0, F.lit("patched")).alias("last_success_at"),
        F.lit("r1").alias("handled_run_now_at"),
    )
    return backup_io.upsert_backup_state(backup_io.read_backup_state(s, path), patch)


def dumped(s: SparkSession, d: str) -> DataFrame:
    """Without a database: the table a dump would read, range by range of its key."""
    return table(s, d, "orders").select("o_orderkey", "o_totalprice")


def artifact_files(s: SparkSession, d: str) -> DataFrame:
    """The files that hold the artifacts of a table, as found in a folder."""
    path, _run = snapshot(s, d, "lineitem")
    files = art.read_artifacts(s, f"{path}/lineitem/artifacts/*.parquet")
    return files.agg((F.count(F.lit(1)) > 0).alias("found"), (F.sum(F.octet_length("artifact")) > 1000).alias("has_bytes"))


def restored_files(s: SparkSession, d: str) -> DataFrame:
    """Artifacts of all line items stored one to a file, found in the folder, opened and restored."""
    path, _run = snapshot(s, d, "lineitem")
    artifacts, manifest = art.read_snapshot(s, path, "lineitem")
    folder = scratch_path(s, "artifact-files")
    art.write_artifact_files(artifacts, folder)
    files = art.read_artifacts(s, folder, "lineitem")
    return restore_artifacts(files, KEY, table(s, d, "lineitem").schema, manifest)


def encrypted_copy(s: SparkSession, d: str) -> DataFrame:
    """Snapshot of all orders, written, read back and decrypted."""
    path, _run = snapshot(s, d)
    artifacts, _manifest = art.read_snapshot(s, path, "orders")
    return restore_artifacts(artifacts, KEY, table(s, d, "orders").schema)


def spooled(s: SparkSession, d: str) -> DataFrame:
    path = scratch_path(s, "spool")
    items = view(s, d, "telemetry").select(
        "event_id", "ts", (F.col("user_id") % 3).alias("shard"),
        F.to_json(F.struct("event_id", "message", F.repeat(F.lit("x"), (F.col("event_id") % 9000).cast("int")).alias("pad"))).alias("item_json"),
    )
    spool.write_spool(items, path, "shard")
    kept = spool.read_spool(s, path, F.lit(QUEUE_NOW).cast("timestamp_ntz"), ttl_hours=24 * 30)
    return kept.select("event_id", F.get_json_object("item_json", "$.message").alias("message"))


def _stream_table(s: SparkSession, d: str, name: str) -> DataFrame:
    schema = table(s, d, name).schema
    return s.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _stream_view(s: SparkSession, d: str, name: str) -> DataFrame:
    sql = VIEWS[name].replace("{", "{{").replace("}", "}}").replace("from events", "from {events}")
    return s.sql(sql, events=_stream_table(s, d, "events"))


def _run(writer, s: SparkSession) -> None:
    available_now(writer).option("checkpointLocation", scratch_path(s, "checkpoint")).start().awaitTermination()


def streamed_verdicts(s: SparkSession, d: str) -> DataFrame:
    out = scratch_path(s, "verdicts")
    requests = _stream_view(s, d, "requests").withColumn(
        "ip", normalize_ip(client_ip("xff", "x_real_ip", socket_addr="remote_addr"))
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.select("req_id", "ip", "matched_value", "action").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(stream_match(requests, lambda: view(s, d, "blocklist"), sink), s)
    return s.read.parquet(out).drop("batch")


def _in_slices(
    s: SparkSession, rows: DataFrame, ts: str, end: dict[str, Column], stateful: Callable[[DataFrame], DataFrame], slices: int = 2
) -> DataFrame:
    """``rows`` as a stream that arrives slice by slice of time and is stopped and started again after each.

    A last row, long after all others, moves the clock past every timer.
    """
    source, out, checkpoint = scratch_path(s, "arriving"), scratch_path(s, "streamed"), scratch_path(s, "checkpoint")
    first, last = rows.agg(F.min(ts), F.max(ts)).first()
    step = (last - first) / slices
    at = F.col(ts)
    bounds = [F.lit(first + step * i).cast("timestamp_ntz") for i in range(1, slices)]
    parts = [rows.where(low & high) for low, high in zip([F.lit(True), *[at >= b for b in bounds]], [*[at < b for b in bounds], F.lit(True)])]
    closing = s.range(1).select(*[end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    for part in [*parts, closing]:
        part.write.mode("append").parquet(source)
        result = stateful(s.readStream.schema(rows.schema).parquet(source))
        writer = available_now(micro_batches(result)).format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.start().awaitTermination()
    return s.read.schema(result.schema).parquet(out)


def _after_all() -> Column:
    return F.lit("2999-01-01 00:00:00").cast("timestamp_ntz")


def streamed_pairs(s: SparkSession, d: str, lifetime_ms: int | None = None) -> DataFrame:
    marks = view(s, d, "marks").selectExpr("cast(user_id as string) as client", "name", "event_id as mark_id", "ts", "kind")
    end = {"client": F.lit(""), "name": F.lit(""), "mark_id": F.lit(-1), "ts": _after_all(), "kind": F.lit("end")}
    return _in_slices(s, marks, "ts", end, lambda rows: stream_pairs(rows, lifetime_ms))


def streamed_flushes(s: SparkSession, d: str) -> DataFrame:
    events = view(s, d, "arrivals")
    end = {"client": F.lit(-1), "event_id": F.lit(-1), "ts": _after_all(), "urgent": F.lit(True)}
    sent = _in_slices(s, events, "ts", end, lambda rows: stream_flushes(rows, ("client",), urgent=F.col("urgent")))
    return sent.where("client >= 0")


def flushed_batches(s: SparkSession, d: str) -> DataFrame:
    """The batches that the same arrivals are sent in, from the table."""
    sent = flush_batches(view(s, d, "arrivals"), "client", urgent=F.col("urgent"))
    return sent.groupBy("client", "batch_no", "reason", "flushed_at").agg(F.count(F.lit(1)).alias("n"))


def streamed_expiry(s: SparkSession, d: str) -> DataFrame:
    """Items created up to four hours ago, by how far the event lies back; half of them live on."""
    out = scratch_path(s, "fresh")
    created = F.current_timestamp().cast("timestamp_ntz") - F.make_dt_interval(mins=(F.col("event_id") % 8 * 30 + 15).cast("int"))
    rows = drop_expired_stream(_stream_table(s, d, "events").withColumn("created_at", created)).select("event_id", "ts")
    _run(micro_batches(rows).format("parquet").option("path", out), s)
    return s.read.parquet(out)


QUERIES = {
    "S1_read_events": read_events,
    "S1_stream_events": stream_events,
    "S2_explode_batches": exploded,
    "S3_write_batches": lambda s, d: _envelopes(s, d),
    "S4_blocklist_snapshots": blocklist_versions,
    "S4_blocklist_snapshots_all": blocklist_versions,
    "S5_backup_policy": policies,
    "S6_backup_state": states,
    "S7_database_table": dumped,
    "S8_encrypted_snapshot": encrypted_copy,
    "S9_read_artifacts": artifact_files,
    "S9_restore_files": restored_files,
    "S10_spool": spooled,
    "F13_stream_match": streamed_verdicts,
    "Q4_drop_expired_stream": streamed_expiry,
    "Q14_micro_batches": flushed_batches,
    "Q14_flush_stream": streamed_flushes,
    "T1_pair_timers_stream": streamed_pairs,
    "T1_expiring_pairs_stream": lambda s, d: streamed_pairs(s, d, MARK_LIFETIME_MS),
    "T1_pair_timers_stream_all": streamed_pairs,
}

_FLUSHES_SQL = """with e as (select *, epoch_us(ts) // 5000000 as tick from $arrivals),
        parts as (select *, count(*) filter (urgent) over (partition by client, tick order by ts, event_id rows between unbounded preceding and 1 preceding) as part from e),
        tens as (select *, (row_number() over (partition by client, tick, part order by ts, event_id) - 1) // 10 as ten from parts),
        sized as (select *, count(*) over w as n, last_value(urgent) over (w order by ts, event_id rows between unbounded preceding and unbounded following) as ends_urgent,
            last_value(ts) over (w order by ts, event_id rows between unbounded preceding and unbounded following) as last_ts,
            row_number() over (w order by ts, event_id) - 1 as pos from tens window w as (partition by client, tick, part, ten)),
        flushes as (select client, event_id, dense_rank() over (partition by client order by tick, part, ten) as batch_no, cast(pos as integer) as pos,
          case when n = 10 then 'full' when ends_urgent then 'urgent' else 'timer' end as reason,
          case when n = 10 or ends_urgent then last_ts else make_timestamp((tick + 1) * 5000000) end as flushed_at
        from sized)"""

#: Half of the marks of the test data are stopped later than this.
MARK_LIFETIME_MS = 12 * 3600 * 1000

_EVENTS_SQL = "select event_id, type, message from $telemetry where event_id % 50 <> 0"
_REQUESTS_SQL = """req as (select event_id, case when batch_id % 7 = 0 then -event_id else batch_id end as batch_id,
    cast(case when batch_id % 7 = 0 then 0 else pos end as integer) as pos, status from $sent)"""

ORACLE = {
    "S1_read_events": _EVENTS_SQL,
    "S1_stream_events": _EVENTS_SQL,
    "S2_explode_batches": f"with {_REQUESTS_SQL} select batch_id, pos, event_id from req",
    "S3_write_batches": f"""with {_REQUESTS_SQL}, b as (select batch_id, cast(count(*) as integer) as n_events,
          string_agg('{{"event_id":' || event_id || ',"status":' || status || '}}', ',' order by pos) as items
          from req group by batch_id)
        select batch_id, 0::bigint as chunk, n_events,
          case when n_events = 1 then items else '{{"events":[' || items || ']}}' end as body from b""",
    "S4_blocklist_snapshots": """select to_timestamp(0)::timestamp + to_milliseconds(1704067200000 + event_id) as fetched_at,
          'ENFORCE' as mode, '10.0.0.' || user_id % 256 as value,
          case when event_id % 2 = 0 then timestamp '2024-02-01 00:00:00' end as expires_at
        from events where event_id % 3 > 0 and event_id % 7 > 0""",
    "S5_backup_policy": """select 'p' || user_id as project_id, max(event_id) % 3 > 0 as enabled,
          cast(max(event_id) % 48 as integer) as interval_hours, cast(max(event_id) % 24 as integer) as preferred_hour_utc,
          500 as max_size_mb from events group by user_id""",
    "S6_backup_state": """select 'p' || c_custkey as project_id, 'a' as last_attempt_at,
          case when c_custkey % 3 = 0 and c_custkey % 9 > 0 then 'patched'
               when c_custkey % 2 = 1 then 's' || c_custkey end as last_success_at,
          case when c_custkey % 3 = 0 then 'r1' end as handled_run_now_at from customer""",
    "S7_database_table": "select o_orderkey, o_totalprice from orders",
    "S8_encrypted_snapshot": "select * from orders",
    "S9_read_artifacts": "select count(*) > 0 as found, true as has_bytes from lineitem",
    "S9_restore_files": "select * from lineitem",
    "S10_spool": f"""with items as (select event_id, ts, user_id % 3 as shard, {sql_emails(sql_key_values('message'))} as message,
            event_id % 9000 as pad from $telemetry),
        sized as (select *, length('{{"event_id":' || event_id || ',"message":"' || message || '","pad":"' || repeat('x', cast(pad as int)) || '"}}') as n from items),
        run as (select *, sum(n) over (partition by shard order by ts, event_id rows unbounded preceding) as total from sized where n <= 8192)
        select event_id, message from run where total <= 1048576 and ts > timestamp '{QUEUE_NOW}' - interval 720 hour""",
    "F13_stream_match": f"""with {_MATCH} select req_id, ip, matched_value,
          case when matched_pos is not null then 'block' else 'pass' end as action from matched""",
    "Q4_drop_expired_stream": "select event_id, ts from events where event_id % 8 < 4",
    "Q14_micro_batches": f"""{_FLUSHES_SQL}
        select client, batch_no, reason, flushed_at, count(*) as n from flushes group by all""",
    "Q14_flush_stream": f"""{_FLUSHES_SQL}
        select * from flushes""",
    "T1_expiring_pairs_stream": f"""with {_PAIRS_SQL}
        select * from pairs where duration_ms <= {MARK_LIFETIME_MS}""",
    "T1_pair_timers_stream": f"with {_PAIRS_SQL} select * from pairs",
}
#: The same queries by earlier names.
ORACLE |= {f"{name}_all": ORACLE[name] for name in ("S4_blocklist_snapshots", "T1_pair_timers_stream")}
