"""Queue, delivery, timer and signature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions.delay import next_attempt, next_poll, retry_schedule
from signalloom.functions.hashing import hmac_sha256_hex
from signalloom.operators import delivery as Q
from signalloom.operators import signing as H
from signalloom.operators import timers as T
from signalloom.plans.views import table, view

NOW = "2024-01-30 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


def _queue(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "queue")


def requeued(s: SparkSession, d: str) -> DataFrame:
    rows = _queue(s, d).select("event_id", "user_id", "ts", "retries")
    failed = rows.filter(F.col("event_id") % 6 == 0)
    waiting = rows.filter(F.col("event_id") % 6 > 0)
    return Q.requeue_front(waiting, failed, 40, "user_id", now=_now())


def delivered(s: SparkSession, d: str) -> DataFrame:
    sent = view(s, d, "sent").drop("body")
    return Q.reconcile_delivery(
        Q.join_acks(sent, view(s, d, "acks")), flush_failed=F.col("status") == 500, cap_always=False
    )


def queue_inspection(s: SparkSession, d: str) -> DataFrame:
    """Sizes per user, and of the drained queue."""
    drained, empty = Q.drain(_queue(s, d).select("event_id", "user_id", "ts"))
    per_user = Q.queue_sizes(drained, "user_id").select(F.col("user_id").cast("string").alias("name"), "size", "is_empty")
    after = Q.queue_sizes(empty).select(F.lit("drained").alias("name"), "size", "is_empty")
    return per_user.unionByName(after)


def backoff(s: SparkSession, d: str) -> DataFrame:
    n = (F.col("event_id") % 12).cast("int")
    schedule = retry_schedule(F.col("event_id") % 4)
    return table(s, d, "events").select(
        "event_id",
        next_attempt(n).alias("wait_ms"),
        next_poll(n).alias("poll_ms"),
        next_attempt(n, maximum=2**31 - 1).alias("report_ms"),
        F.size(schedule).alias("n_waits"),
        F.aggregate(schedule, F.lit(0.0), lambda a, x: a + x).alias("total_wait_ms"),
    )


def marks(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "marks").select(
        F.col("user_id").cast("string").alias("client"), "name", F.col("event_id").alias("mark_id"), "ts", "kind"
    )


def timers(s: SparkSession, d: str) -> DataFrame:
    events = T.timer_events(
        T.pair_timers(marks(s, d)).withColumn("extra", F.create_map(F.lit("client"), F.col("client"))), "extra"
    )
    return events.select("mark_id", "type", "debug_type", "data", "performance.duration", "performance.startTime", "performance.endTime")


def measured(s: SparkSession, d: str) -> DataFrame:
    calls = T.pair_timers(marks(s, d)).withColumn(
        "error_message", F.when(F.col("mark_id") % 3 == 0, F.concat(F.lit("token: t"), F.col("mark_id").cast("string")))
    )
    return T.measure_outcomes(calls).select("mark_id", "type", "event_type", "severity", "message", "duration")


def measured_with_secrets(s: SparkSession, d: str) -> DataFrame:
    """Failed calls whose text, stack and metadata hold secrets."""
    n = F.col("mark_id").cast("string")
    failed = F.col("mark_id") % 2 == 0
    calls = T.pair_timers(marks(s, d)).withColumns(
        {
            "error_message": F.when(failed, F.concat(F.lit("password=hunter"), n)),
            "stack": F.when(failed, F.concat(F.lit("at f token=abc"), n, F.lit(" \n at g by user"), n, F.lit("@mail.example.com"))),
            "about": F.create_map(F.lit("client"), F.col("client"), F.lit("apiKey"), n),
        }
    )
    out = T.measure_outcomes(calls, "about")
    given = F.coalesce("metadata", "data")
    return out.select(
        "mark_id", "type", "message", "stack",
        F.get_json_object(given, "$.client").alias("client"),
        F.get_json_object(given, "$.apiKey").alias("api_key"),
        F.lit(bool({"error_message", "about"} & set(out.columns))).alias("raw_left"),
    )


# --- signatures: a secret per user, made from the user's number ----------------

_SECRET = "repeat(concat('k', cast(user_id as string)), cast(user_id % 40 + 1 as int))"


def secrets(s: SparkSession, d: str) -> DataFrame:
    users = table(s, d, "events").select("user_id").distinct()
    return users.selectExpr("concat('key_', cast(user_id as string)) as key_id", f"{_SECRET} as secret")


def bodies(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select(
        "event_id",
        F.concat(F.lit("key_"), F.col("user_id").cast("string")).alias("key_id"),
        F.to_json(F.struct(F.col("event_type").alias("message"), "event_id")).alias("body"),
        (F.lit(1704067200) + F.col("event_id")).alias("at"),
    )


def signed(s: SparkSession, d: str) -> DataFrame:
    return H.sign_bodies(bodies(s, d), secrets(s, d), "at")


def _tampered(df: DataFrame) -> DataFrame:
    """Every 5th body changed, every 7th under an unknown key."""
    return df.withColumns(
        {
            "body": F.when(F.col("event_id") % 5 == 0, F.regexp_replace("body", r"\}\z", " }")).otherwise(F.col("body")),
            "key_id": F.when(F.col("event_id") % 7 == 0, "nobody").otherwise(F.col("key_id")),
        }
    )


_AT = 1704067200


def verified(s: SparkSession, d: str) -> DataFrame:
    return H.verify_bodies(_tampered(signed(s, d)), secrets(s, d), F.lit(_AT + 400)).select("event_id", "signature_status")


def verified_embedded(s: SparkSession, d: str) -> DataFrame:
    packed = H.embed_signature(signed(s, d))
    loose = packed.select(
        "event_id",
        F.when(F.col("event_id") % 11 == 0, F.lit('{"message":"x"}'))
        .when(F.col("event_id") % 5 == 0, F.replace("body", F.lit('"message":"'), F.lit('"message":"!')))
        .otherwise(F.col("body"))
        .alias("body"),
    )
    return H.verify_embedded(loose, secrets(s, d), F.lit(_AT + 400)).select("event_id", "signature_status")


QUERIES = {
    "Q1_keep_latest": lambda s, d: Q.keep_latest(_queue(s, d), 25, "user_id").select("event_id", "user_id"),
    "Q1_keep_latest_whole_queue": lambda s, d: Q.keep_latest(_queue(s, d)).select("event_id", "user_id"),
    "Q1_keep_most_of_queue": lambda s, d: Q.keep_latest(_queue(s, d), 5000).select("event_id", "user_id"),
    "Q2_take_many_per_key": lambda s, d: Q.take_front(_queue(s, d).withColumn("shard", F.col("user_id") % 2), 2500, "shard").select("event_id", "user_id"),
    "Q2_take_front": lambda s, d: Q.take_front(_queue(s, d), 10, "user_id").select("event_id", "user_id"),
    "Q3_requeue_front": requeued,
    "Q4_drop_expired": lambda s, d: Q.drop_expired(_queue(s, d), _now(), created="ts").select("event_id", "ts"),
    "Q5_persist_budget": lambda s, d: Q.persist_budget(
        _queue(s, d).withColumn("shard", F.col("user_id") % 3), "item_json", "shard"
    ).select("event_id", "shard"),
    "Q6_assign_batches": lambda s, d: Q.assign_batches(_queue(s, d).drop("item_json"), "user_id").select(
        "event_id", "user_id", "batch_no", "pos"
    ),
    "Q7_batch_size_gate": lambda s, d: Q.batch_size_gate(view(s, d, "sent")).select("event_id", "gate"),
    "Q7_batch_sizes": lambda s, d: Q.batch_sizes(view(s, d, "sent")),
    "Q8_join_acks": lambda s, d: Q.join_acks(view(s, d, "sent").drop("body"), view(s, d, "acks")).select(
        "event_id", "success", "ack_id", "ack_type"
    ),
    "Q9_reconcile_delivery": lambda s, d: delivered(s, d).select("event_id", "outcome"),
    "Q9_delivery_counts": lambda s, d: Q.delivery_counts(delivered(s, d)),
    "Q10_split_rejected": lambda s, d: Q.split_rejected_batches(view(s, d, "sent").drop("body")).select(
        "event_id", "next_step", "send_id", "error"
    ),
    "Q11_next_attempt": backoff,
    "Q12_queue_inspection": queue_inspection,
    "Q13_delivery_stats": lambda s, d: Q.delivery_stats(delivered(s, d)),
    "T1_pair_timers": lambda s, d: T.pair_timers(marks(s, d)),
    "T1_pair_timers_all": lambda s, d: T.pair_timers(marks(s, d)),
    "T2_timer_events_all": timers,
    "T3_measure_secrets": measured_with_secrets,
    "T3_measure_outcomes_all": measured,
    "T2_timer_events": timers,
    "T3_measure_outcomes": measured,
    "H1_hmac_sha256": lambda s, d: table(s, d, "customer").select(
        "c_custkey", hmac_sha256_hex("c_mktsegment", "c_name").alias("mac")
    ),
    "H2_sign_bodies": lambda s, d: signed(s, d).select("event_id", "timestamp", "signature"),
    "H3_verify_bodies": verified,
    "H4_verify_embedded": verified_embedded,
}


def _pads_sql(secret: str) -> str:
    """HMAC pads of a secret in SQL, byte by byte."""
    raw = f"case when strlen({secret}) > 64 then sha256({secret}) else lower(hex({secret})) end"
    key = f"rpad({raw}, 128, '0')"

    def pad(byte: int) -> str:
        one = f"xor(('0x' || substr({key}, 2 * i - 1, 2))::integer, {byte})"
        return f"array_to_string(list_transform(range(1, 65), lambda i: printf('%02x', {one})), '')"

    return f"{pad(0x36)} as ipad, {pad(0x5C)} as opad"


def _hmac_sql(text: str) -> str:
    return f"sha256(unhex(opad || sha256(unhex(ipad || hex({text})))))"


_SIGNED_SQL = f"""
users as (select distinct user_id from events),
pads as (select user_id, {_pads_sql('sec')} from (select user_id, {_SECRET} as sec from users)),
signed as (select e.event_id, cast(1704067200 + e.event_id as varchar) as timestamp,
  'v1=' || {_hmac_sql("cast(1704067200 + e.event_id as varchar) || '.' || '{\"message\":\"' || e.event_type || '\",\"event_id\":' || e.event_id || '}'")} as signature
  from events e join pads using (user_id))"""

_PAIRS_SQL = """prev as (select *, lag(kind) over w as pk, lag(ts) over w as pts from $marks
    window w as (partition by user_id, name order by ts, event_id)),
  pairs as (select cast(user_id as varchar) as client, name, event_id as mark_id, pts as start_ts, ts as end_ts,
    (epoch_us(ts) - epoch_us(pts)) / 1000.0::double as duration_ms from prev where kind = 'stop' and pk = 'start')"""
_DELIVERED_SQL = """delivered as (select s.*, case when status = 200 then 'delivered'
    when status = 500 or retries < 3 then 'retry' else 'dropped' end as outcome from $sent s)"""

ORACLE = {
    "Q1_keep_latest": """select event_id, user_id from (select *, row_number() over
        (partition by user_id order by ts desc, event_id desc) as rn from $queue) where rn <= 25""",
    "Q1_keep_latest_whole_queue": "select event_id, user_id from $queue order by ts desc, event_id desc limit 1000",
    "Q1_keep_most_of_queue": "select event_id, user_id from $queue qualify row_number() over (order by ts desc, event_id desc) <= 5000",
    "Q2_take_many_per_key": "select event_id, user_id from $queue qualify row_number() over (partition by user_id % 2 order by ts, event_id) <= 2500",
    "Q2_take_front": """select event_id, user_id from (select *, row_number() over
        (partition by user_id order by ts, event_id) as rn from $queue) where rn <= 10""",
    "Q3_requeue_front": f"""with u as (select event_id, user_id, ts, cast(case when event_id % 6 = 0 then retries + 1 else retries end as integer) as retries,
          case when event_id % 6 = 0 then timestamp '{NOW}' end as last_attempt,
          cast(case when event_id % 6 = 0 then 0 else 1 end as integer) as prio from $queue)
        select * exclude rn from (select *, row_number() over (partition by user_id order by prio, ts, event_id) as rn from u)
        where rn <= 40""",
    "Q4_drop_expired": f"select event_id, ts from $queue where ts > timestamp '{NOW}' - interval 2 hour",
    "Q5_persist_budget": """with sized as (select event_id, user_id % 3 as shard, ts, length(item_json) as n from $queue),
        run as (select *, sum(n) over (partition by shard order by ts, event_id rows unbounded preceding) as total
                from sized where n <= 8192)
        select event_id, shard from run where total <= 1048576""",
    "Q6_assign_batches": """select event_id, user_id, cast(floor((rn - 1) / 10) as bigint) as batch_no, cast((rn - 1) % 10 as integer) as pos
        from (select *, row_number() over (partition by user_id order by ts, event_id) as rn from $queue)""",
    "Q7_batch_size_gate": """with t as (select *, strlen(body) as b, sum(strlen(body)) over p as total, count(*) over p as n
          from $sent window p as (partition by batch_id))
        select event_id, case when (case when n = 1 then total else total + 13 + n - 1 end) <= 262144 then 'send'
               when n > 1 and b <= 262144 then 'split' else 'failed' end as gate from t""",
    "Q7_batch_sizes": """select batch_id, count(*) as n_events,
          cast(sum(strlen(body)) + case when count(*) = 1 then 0 else 13 + count(*) - 1 end as bigint) as batch_bytes
        from $sent group by batch_id""",
    "Q8_join_acks": """select s.event_id, s.status = 200 as success, case when s.status = 200 then a.ack_id end as ack_id,
          case when s.status = 200 then a.ack_type end as ack_type
        from $sent s left join $acks a using (batch_id, pos)""",
    "Q9_reconcile_delivery": f"with {_DELIVERED_SQL} select event_id, outcome from delivered",
    "Q9_delivery_counts": f"with {_DELIVERED_SQL} select outcome, count(*) as n from delivered group by outcome",
    "Q10_split_rejected": """select event_id, case status when 200 then 'done' when 400 then 'resend_single' else 'failed' end as next_step,
          case when status = 400 then batch_id || '-' || pos else cast(batch_id as varchar) end as send_id,
          case when status not in (200, 400) then 'HTTP ' || status end as error from $sent""",
    "Q11_next_attempt": """select event_id, least(1000 * pow(2, n), 30000) as wait_ms,
          case when n = 0 then 45000.0::double else least(45000 * pow(2, n), 300000) end as poll_ms,
          1000 * pow(2, n) as report_ms, cast(event_id % 4 as integer) as n_waits,
          case event_id % 4 when 0 then 0 when 1 then 1000 when 2 then 3000 else 7000 end::double as total_wait_ms
        from (select event_id, event_id % 12 as n from events)""",
    "Q12_queue_inspection": """select cast(user_id as varchar) as name, count(*) as size, false as is_empty from $queue group by user_id
        union all select 'drained', 0, true""",
    "Q13_delivery_stats": f"""with {_DELIVERED_SQL} select count(*) filter (outcome = 'retry') as queue_size, count(*) as total_events,
          count(distinct case when outcome = 'delivered' then batch_id end) as total_flushes,
          count(*) filter (outcome = 'dropped') as total_errors, '0.1.0' as version from delivered""",
    "T1_pair_timers": f"with {_PAIRS_SQL} select * from pairs",
    "T2_timer_events": f"""with {_PAIRS_SQL} select mark_id, 'debug' as type, 'performance' as debug_type,
          '{{"name":"' || name || '","client":"' || client || '"}}' as data,
          floor(duration_ms * 100 + 0.5) / 100 as duration, start_ts as "startTime", end_ts as "endTime" from pairs""",
    "T3_measure_secrets": f"""with {_PAIRS_SQL} select mark_id, case when mark_id % 2 = 0 then 'error' else 'debug' end as type,
          case when mark_id % 2 = 0 then 'Performance measurement "' || name || '" failed: password=[REDACTED]' end as message,
          case when mark_id % 2 = 0 then 'at f token=[REDACTED] ' || chr(10) || ' at g by *@mail.example.com' end as stack,
          client, '[REDACTED]' as api_key, false as raw_left from pairs""",
    "T3_measure_outcomes": f"""with {_PAIRS_SQL} select mark_id, case when mark_id % 3 = 0 then 'error' else 'debug' end as type,
          case when mark_id % 3 = 0 then 'RUNTIME' else 'performance' end as event_type,
          case when mark_id % 3 = 0 then 'MEDIUM' end as severity,
          case when mark_id % 3 = 0 then 'Performance measurement "' || name || '" failed: token: [REDACTED]' end as message,
          case when mark_id % 3 <> 0 then floor(duration_ms * 100 + 0.5) / 100 end as duration from pairs""",
    "H1_hmac_sha256": f"""select c_custkey, {_hmac_sql('c_name')} as mac
        from (select c_custkey, c_name, c_mktsegment, {_pads_sql('c_mktsegment')} from customer)""",
    "H2_sign_bodies": f"with {_SIGNED_SQL} select event_id, timestamp, signature from signed",
    "H3_verify_bodies": """select event_id, case when event_id % 7 = 0 then 'unknown_key' when event_id % 5 = 0 then 'bad_signature'
          when abs(400 - event_id) > 300 then 'stale' else 'ok' end as signature_status from events""",
    "H4_verify_embedded": """select event_id, case when event_id % 11 = 0 then 'unsigned' when event_id % 5 = 0 then 'bad_signature'
          when abs(400 - event_id) > 300 then 'stale' else 'ok' end as signature_status from events""",
}
#: The same queries by earlier names.
ORACLE |= {
    f"{name}_all": ORACLE[name]
    for name in ("T1_pair_timers", "T2_timer_events", "T3_measure_outcomes")
}
