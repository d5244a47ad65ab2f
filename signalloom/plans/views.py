"""Derived views: telemetry shapes made from the given tables.

The SQL runs unchanged in Spark and in DuckDB, so queries and their oracles
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalloom.operators.sizing import TASK_ROWS, spread

TELEMETRY = """
select event_id, ts, user_id,
  case event_type when 'error' then 'error' when 'click' then 'debug'
       when 'purchase' then 'security' else 'log' end as type,
  case when event_id % 11 = 0 then null when event_id % 5 = 0 then 'DEBUG'
       when event_id % 5 = 1 then 'INFO' when event_id % 5 = 2 then 'WARN'
       when event_id % 5 = 3 then 'ERROR' else 'FATAL' end as level,
  case when event_id % 13 = 0
       then concat('user', cast(user_id as string), '@mail.example.com password=p', cast(event_id as string))
       else concat(event_type, ' by ', cast(user_id as string)) end as message,
  case when event_id % 3 = 0 then null else concat('svc', cast(user_id % 4 as string)) end as source,
  props as metadata_json, value
from events
"""

REQUESTS = """
select event_id as req_id, ts,
  case when event_id % 7 = 0 then null
       else concat(' ', case when event_id % 4 = 0 then '::FFFF:' else '' end,
                   '45.198.', cast(224 + user_id % 4 as string), '.', cast(event_id % 256 as string),
                   case when event_id % 2 = 0 then ', 10.0.0.1' else '' end) end as xff,
  case when event_id % 14 = 0 then '9.9.9.9' else null end as x_real_ip,
  case when event_id % 21 = 0 then null else '127.0.0.1' end as remote_addr
from events
"""

BLOCKLIST = """
select * from (values
  (1,'ASN','AS206264',cast(null as timestamp)),
  (2,'IP','45.198.225.10',cast(null as timestamp)),
  (3,'CIDR','45.198.224.0/25',cast(null as timestamp)),
  (4,'CIDR','45.198.224.0/24',timestamp '2024-01-15 00:00:00'),
  (5,'IP','::ffff:9.9.9.9',cast(null as timestamp)),
  (6,'CIDR','45.198.226.0/33',cast(null as timestamp)),
  (7,'CIDR','2001:db8::/32',cast(null as timestamp)),
  (8,'IP','45.198.225.10',cast(null as timestamp)),
  (9,'CIDR','45.198.225.0/26',timestamp '2024-01-20 00:00:00'),
  (10,'IP','45.198.225.11',timestamp '2024-01-10 00:00:00')) as b(pos,type,value,expires_at)
"""

# a list that grows with the customers: nested networks of all lengths, some that expire, a whole eighth and everything
LONG_LIST = """
select c_custkey as pos, case when c_custkey % 5 = 0 then 'IP' else 'CIDR' end as type,
  concat('45.198.', cast(224 + c_custkey % 4 as string), '.', cast(c_custkey * 7 % 256 as string),
    case when c_custkey % 5 = 0 then '' else concat('/', cast(16 + c_custkey % 17 as string)) end) as value,
  case when c_custkey % 3 > 0 then timestamp '2024-01-01 00:00:00' + interval 1 hour * (c_custkey * 13 % 800) end as expires_at
from customer
union all select 1000000000, 'CIDR', '0.0.0.0/0', timestamp '2024-01-20 00:00:00'
union all select 1000000001, 'CIDR', '45.0.0.0/8', timestamp '2024-01-25 00:00:00'
"""

# every event starts or stops a timer
MARKS = """
select event_id, user_id, ts,
  case when event_type in ('click','view','signup') then 'start' else 'stop' end as kind,
  cast(user_id % 3 as string) as name
from events
"""

# all events in quick succession, about four in a second, not quite in order of their ids
ARRIVALS = """
select event_id, cast(user_id % 3 as bigint) as client,
  timestamp '2024-01-01 00:00:00' + interval 1 millisecond * (event_id * 250 + user_id * 37 % 1000) as ts,
  event_type = 'error' and event_id % 7 = 0 as urgent
from events
"""

POLICY = """
select user_id as project_id, concat('key_', cast(user_id as string)) as api_key,
  user_id % 10 <> 0 as enabled,
  case when user_id % 3 = 0 then 6 else 24 end as interval_hours,
  cast(user_id % 24 as int) as preferred_hour_utc,
  case when user_id % 17 = 0 then 'r1' else null end as run_now_at,
  case when user_id % 19 = 0 then null else max(ts) end as last_success_at,
  case when user_id % 7 = 0 then max(ts) else null end as last_attempt_at,
  cast(null as string) as handled_run_now_at
from events group by user_id
"""

# one queue per user: an item per event, in order of (ts, event_id)
QUEUE = """
select event_id, user_id, ts, cast(event_id % 5 as int) as retries,
  concat('{"id":', cast(event_id as string), ',"message":"',
         repeat('x', cast((event_id * 37) % 9000 as int)), '"}') as item_json
from events
"""

# delivered batches: ten consecutive event ids per batch
SENT = """
select event_id, user_id, cast(floor(event_id / 10) as bigint) as batch_id,
  cast(event_id % 10 as int) as pos, cast(event_id % 5 as int) as retries,
  case when floor(event_id / 10) % 17 = 0 then 400 when floor(event_id / 10) % 13 = 0 then 500
       when floor(event_id / 10) % 11 = 0 then 429 when floor(event_id / 10) % 7 = 0 then 404
       else 200 end as status,
  concat('{"message":"', repeat('m', cast((event_id * 131) % (case when floor(event_id / 10) % 12 = 0 then 60000 else 900 end) as int)), '"}') as body
from events
"""

ACKS = """
select cast(floor(event_id / 10) as bigint) as batch_id, cast(event_id % 10 as int) as pos,
  concat('ack-', cast(event_id as string)) as ack_id, event_type as ack_type
from events where event_id % 6 <> 0
"""

POLLS = """
select event_id as poll_id, cast(user_id % 10 as bigint) as client, ts,
  case when event_id % 23 = 0 then null when event_id % 4 = 0 then 200
       when event_id % 4 = 1 then 304 when event_id % 9 = 0 then 429 else 500 end as status,
  case when event_id % 4 = 0 then case when event_id % 3 = 0 then 'ENFORCE'
       when event_id % 3 = 1 then 'MONITOR' else 'OFF' end end as mode,
  case when event_id % 4 = 0 then concat('e', cast(event_id as string)) end as etag
from events
"""

# a list version for every event
VERSIONS = """
select ts as fetched_at,
  case when event_id % 3 = 0 then 'MONITOR' when event_id % 7 = 0 then 'OFF' else 'ENFORCE' end as mode,
  event_id as version_id
from events
"""

# requests to start a run, many while another of the project is going on
STARTS = """
select user_id % 20 as project_id, concat('run-', cast(event_id as string)) as run_id, ts as requested_at,
  ts + interval 1 minute * (event_id * 37 % 400) as busy_until
from events
"""

# two runs at a time per project and 3,000 events: start, heartbeats, final reports
RUNS = """
select event_id, ts, user_id as project_id,
  concat(cast(user_id as string), '-', cast(cast(floor(event_id / 3000) as bigint) as string), '-', cast(event_id % 2 as string)) as run_id,
  case when event_id % 3000 < 1000 then 'start' when event_id % 3000 > 2000 and event_type in ('purchase', 'error') then 'final'
       else 'heartbeat' end as kind,
  case when event_id % 3000 < 1000 then case when event_id % 19 = 0 then 409 when event_id % 31 = 0 then 403 else 200 end end as status,
  case when event_id % 3000 > 2000 then case event_type when 'purchase' then 'UPLOADED' when 'error' then 'FAILED' end end as outcome,
  case when event_type = 'purchase' then cast(event_id * 10 as bigint) end as size_bytes,
  case when event_type = 'purchase' then md5(cast(event_id as string)) end as checksum,
  case when event_type = 'error' then 'boom' end as error
from events
"""

VIEWS = {
    "telemetry": TELEMETRY,
    "requests": REQUESTS,
    "blocklist": BLOCKLIST,
    "long_list": LONG_LIST,
    "marks": MARKS,
    "arrivals": ARRIVALS,
    "policy": POLICY,
    "queue": QUEUE,
    "sent": SENT,
    "acks": ACKS,
    "polls": POLLS,
    "versions": VERSIONS,
    "starts": STARTS,
    "runs": RUNS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table.  Queries make texts of many times their size from events, so tasks get a bounded number of them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), max_rows=TASK_ROWS if name == "events" else None)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    if name == "blocklist":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return spark.sql(sql)
    source = "customer" if "from customer" in sql else "events"
    escaped = sql.replace("{", "{{").replace("}", "}}").replace(f"from {source}", f"from {{{source}}}")
    return spark.sql(escaped, **{source: table(spark, sf_dir, source)})


def with_views(sql: str) -> str:
    """Oracle text: the derived views that ``sql`` names as ``$view``, as CTEs before it."""
    used = [v for v in VIEWS if f"${v}" in sql]
    for v in used:
        sql = sql.replace(f"${v}", f"v_{v}")
    ctes = [f"v_{v} as ({VIEWS[v]})" for v in used]
    body = sql.strip()
    for start in ("with recursive ", "with "):
        if body.lower().startswith(start):
            return start + ", ".join(ctes + [body[len(start) :]]) if ctes else body
    return "with " + ", ".join(ctes) + " " + body if ctes else body
