"""Queries over the request and blocklist views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions.net import client_ip, ipv4_to_long, normalize_ip
from signalloom.operators import blocklist as B
from signalloom.plans.views import view

NOW = "2024-01-16 00:00:00"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "requests").withColumn(
        "ip", normalize_ip(client_ip("xff", "x_real_ip", socket_addr="remote_addr"))
    )


def matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.match_blocklist(requests(spark, sf_dir), view(spark, sf_dir, "blocklist"))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = (
        F.when(F.col("req_id") % 5 == 0, "MONITOR")
        .when(F.col("req_id") % 5 == 1, "OFF")
        .when(F.col("req_id") % 5 == 2, "other")
        .when(F.col("req_id") % 5 == 3, "ENFORCE")
    )
    return B.firewall_verdict(matched(spark, sf_dir).withColumn("mode", mode))


def enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.firewall_verdict(matched(spark, sf_dir), F.lit("ENFORCE"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list version for every event."""
    entry = "array<struct<type:string,value:string,expires_at:timestamp_ntz>>"
    entries = F.when(
        F.col("version_id") % 4 < 2,
        F.expr("array(named_struct('type','CIDR','value','45.198.224.0/24','expires_at',fetched_at + interval 2 days),"
               "named_struct('type','IP','value','9.9.9.9','expires_at',cast(null as timestamp_ntz)))"),
    ).otherwise(
        F.expr("array(named_struct('type','CIDR','value','45.198.224.0/23','expires_at',cast(null as timestamp_ntz)))")
    )
    return view(spark, sf_dir, "versions").select("fetched_at", "mode", entries.cast(entry).alias("entries"))


def later_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests some minutes after their event, so that other versions lie between."""
    late = F.col("ts") + F.make_dt_interval(mins=(F.col("req_id") % 200).cast("int"))
    return requests(spark, sf_dir).withColumn("ts", late)


def requests_of_an_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests within one hour."""
    at = F.expr("timestamp_ntz '2024-01-15 12:00:00' + interval 1 millisecond * (req_id * 997 % 3600000)")
    return requests(spark, sf_dir).withColumn("ts", at)


QUERIES = {
    "F1_client_ip": lambda s, d: view(s, d, "requests").select(
        "req_id", client_ip("xff", "x_real_ip", socket_addr="remote_addr").alias("client_ip")
    ),
    "F2_normalize_ip": lambda s, d: requests(s, d).select("req_id", "ip"),
    "F3_ipv4_to_long": lambda s, d: requests(s, d).select("req_id", ipv4_to_long("ip").alias("addr")),
    "F4_exact_match": lambda s, d: B.match_blocklist(
        requests(s, d), view(s, d, "blocklist").filter("type = 'IP'"), ts=F.lit(NOW)
    )
    .filter("matched_pos is not null")
    .select("req_id", "ip", "matched_pos"),
    "F5_cidr_match": lambda s, d: B.match_blocklist(
        requests(s, d), view(s, d, "blocklist").filter("type = 'CIDR'"), ts=F.lit(NOW)
    )
    .filter("matched_pos is not null")
    .select("req_id", "ip", "matched_pos"),
    "F6_entry_expiry": lambda s, d: B.match_blocklist(
        requests(s, d), view(s, d, "blocklist").filter("expires_at is not null")
    )
    .filter("matched_pos is not null")
    .select("req_id", "matched_pos"),
    "F7_match_blocklist": lambda s, d: matched(s, d).select("req_id", "ip", "matched_pos", "matched_value"),
    "F7_match_blocklist_shuffled": lambda s, d: B.match_blocklist(
        requests(s, d), view(s, d, "blocklist"), max_broadcast_rows=0
    ).select("req_id", "ip", "matched_pos", "matched_value"),
    "F7_match_ranges": lambda s, d: B.match_blocklist(
        requests(s, d), view(s, d, "long_list"), max_broadcast_rows=0
    ).select("req_id", "ip", "matched_pos", "matched_value"),
    "F8_firewall_verdict": lambda s, d: verdicts(s, d).select("req_id", "mode", "action", "status", "report_type"),
    "F9_firewall_events": lambda s, d: B.firewall_events(verdicts(s, d)).select(
        "req_id", "event_kind", "report_type", "ip", "description", "metadata_json"
    ),
    "F10_blocked": lambda s, d: B.blocked(enforced(s, d)).select("req_id", "ip"),
    "F10_allowed": lambda s, d: B.allowed(enforced(s, d)).select("req_id", "ip"),
    "F11_match_point_in_time": lambda s, d: B.match_point_in_time(requests(s, d), versions(s, d)).select(
        "req_id", "valid_from", "mode", "matched_value"
    ),
    "F11_match_point_in_time_all": lambda s, d: B.match_point_in_time(later_requests(s, d), versions(s, d)).select(
        "req_id", "valid_from", "mode", "matched_value"
    ),
    "F11_match_one_hour": lambda s, d: B.match_point_in_time(
        requests_of_an_hour(s, d), versions(s, d), max_broadcast_rows=0
    ).select("req_id", "valid_from", "mode", "matched_value"),
    "F12_fold_polls": lambda s, d: B.fold_polls(view(s, d, "polls")).select(
        "poll_id", "state_mode", "state_etag", "fetched_at", "errors_in_row", "next_poll_ms"
    ),
}

_CLIENT = """case when length(xff) > 0 then trim(split_part(xff, ',', 1))
  when length(x_real_ip) > 0 then x_real_ip
  else coalesce(nullif(remote_addr, ''), 'unknown') end"""
_IP = f"regexp_replace(lower({_CLIENT}), '^::ffff:([0-9.]+)$', '\\1')"


def _long(c: str) -> str:
    return (
        f"(split_part({c}, '.', 1)::bigint * 16777216 + split_part({c}, '.', 2)::bigint * 65536"
        f" + split_part({c}, '.', 3)::bigint * 256 + split_part({c}, '.', 4)::bigint)"
    )


# every request against every entry, as the definition says
_MATCH = f"""
req as (select req_id, ts, ip, case when regexp_full_match(ip, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+')
          then {_long('ip')} end as addr
        from (select req_id, ts, {_IP} as ip from $requests)),
lst as (select pos, type, value, expires_at::timestamp as expires_at,
          regexp_replace(lower(value), '^::ffff:([0-9.]+)$', '\\1') as norm,
          case when type = 'CIDR' and value like '%.%.%.%/%' then {_long("split_part(value, '/', 1)")} end as net,
          case when type = 'CIDR' then split_part(value, '/', 2)::bigint end as len
        from $blocklist),
pairs as (select r.req_id, r.ip, r.ts, l.pos, l.value, l.type, l.expires_at from req r join lst l on
          (l.type = 'IP' and l.norm = r.ip and r.ip not in ('', 'unknown'))
          or (l.net is not null and l.len between 0 and 32
              and (r.addr >> (32 - l.len)) = (l.net >> (32 - l.len)))),
hit as (select req_id, min(pos) as matched_pos, arg_min(value, pos) as matched_value from pairs
        where expires_at is null or expires_at > ts group by req_id),
matched as (select r.req_id, r.ip, h.matched_pos, h.matched_value from req r left join hit h using (req_id))
"""
_MODE = """case when req_id % 5 = 0 then 'MONITOR' when req_id % 5 = 1 then 'OFF'
  when req_id % 5 = 2 then 'other' when req_id % 5 = 3 then 'ENFORCE' end"""
_VERDICT = f"""
moded as (select *, {_MODE} as mode from matched),
verdict as (select *, case when matched_pos is not null and mode = 'ENFORCE' then 'block' else 'pass' end as action,
  case when matched_pos is not null and mode = 'ENFORCE' then 403 end as status,
  case when matched_pos is not null and mode = 'ENFORCE' then 'FIREWALL_BLOCK'
       when matched_pos is not null and mode = 'MONITOR' then 'FIREWALL_WOULD_BLOCK' end as report_type from moded)
"""

ORACLE = {
    "F1_client_ip": f"select req_id, {_CLIENT} as client_ip from $requests",
    "F2_normalize_ip": f"select req_id, {_IP} as ip from $requests",
    "F3_ipv4_to_long": f"with {_MATCH.split('lst as')[0].strip().rstrip(',')} select req_id, addr from req",
    "F4_exact_match": f"""with {_MATCH} select req_id, ip, min(pos) as matched_pos from pairs
        where type = 'IP' and (expires_at is null or expires_at > timestamp '{NOW}') group by all""",
    "F5_cidr_match": f"""with {_MATCH} select req_id, ip, min(pos) as matched_pos from pairs
        where type = 'CIDR' and (expires_at is null or expires_at > timestamp '{NOW}') group by all""",
    "F6_entry_expiry": f"""with {_MATCH} select req_id, min(pos) as matched_pos from pairs
        where expires_at > ts group by all""",
    "F7_match_blocklist": f"with {_MATCH} select req_id, ip, matched_pos, matched_value from matched",
    "F7_match_blocklist_shuffled": f"with {_MATCH} select req_id, ip, matched_pos, matched_value from matched",
    "F7_match_ranges": f"with {_MATCH.replace('$blocklist', '$long_list')} select req_id, ip, matched_pos, matched_value from matched",
    "F8_firewall_verdict": f"with {_MATCH}, {_VERDICT} select req_id, mode, action, status, report_type from verdict",
    "F9_firewall_events": f"""with {_MATCH}, {_VERDICT} select req_id, 'security' as event_kind, report_type, ip,
        case when action = 'block' then 'Firewall: blocked ' else 'Firewall (monitor): would block ' end
          || ip || ' (rule ' || matched_value || ')' as description,
        '{{"matchedValue":"' || matched_value || '"}}' as metadata_json
        from verdict where report_type is not null""",
    "F10_blocked": f"with {_MATCH} select req_id, ip from matched where matched_pos is not null",
    "F10_allowed": f"with {_MATCH} select req_id, ip from matched where matched_pos is null",
    "F11_match_point_in_time": f"""with {_MATCH.split('lst as')[0].strip().rstrip(',')},
        placed as (select r.*, v.fetched_at as valid_from, v.mode, v.version_id
                   from req r asof left join $versions v on r.ts >= v.fetched_at)
        select req_id, valid_from, mode, case
          when version_id % 4 < 2 then case
            when (addr >> 8) = ({_long("'45.198.224.0'")} >> 8) and ts < valid_from + interval 2 day then '45.198.224.0/24'
            when ip = '9.9.9.9' then '9.9.9.9' end
          when (addr >> 9) = ({_long("'45.198.224.0'")} >> 9) then '45.198.224.0/23' end as matched_value
        from placed""",
    "F11_match_point_in_time_all": f"""with {_MATCH.split('lst as')[0].strip().rstrip(',')},
        late as (select * replace (ts + to_minutes(req_id % 200) as ts) from req),
        placed as (select r.*, v.fetched_at as valid_from, v.mode, v.version_id
                   from late r asof left join $versions v on r.ts >= v.fetched_at)
        select req_id, valid_from, mode, case
          when version_id % 4 < 2 then case
            when (addr >> 8) = ({_long("'45.198.224.0'")} >> 8) and ts < valid_from + interval 2 day then '45.198.224.0/24'
            when ip = '9.9.9.9' then '9.9.9.9' end
          when (addr >> 9) = ({_long("'45.198.224.0'")} >> 9) then '45.198.224.0/23' end as matched_value
        from placed""",
    "F11_match_one_hour": f"""with {_MATCH.split('lst as')[0].strip().rstrip(',')},
        late as (select * replace (timestamp '2024-01-15 12:00:00' + to_milliseconds(req_id * 997 % 3600000) as ts) from req),
        placed as (select r.*, v.fetched_at as valid_from, v.mode, v.version_id
                   from late r asof left join $versions v on r.ts >= v.fetched_at)
        select req_id, valid_from, mode, case
          when version_id % 4 < 2 then case
            when (addr >> 8) = ({_long("'45.198.224.0'")} >> 8) and ts < valid_from + interval 2 day then '45.198.224.0/24'
            when ip = '9.9.9.9' then '9.9.9.9' end
          when (addr >> 9) = ({_long("'45.198.224.0'")} >> 9) then '45.198.224.0/23' end as matched_value
        from placed""",
    "F12_fold_polls": """with flagged as (select *, coalesce(status between 200 and 299, false) as ok,
          coalesce(status between 200 and 299 or status = 304, false) as good from $polls),
        grp as (select *, last_value(case when ok then mode end ignore nulls) over w as m0,
          last_value(case when ok then etag end ignore nulls) over w as state_etag,
          last_value(case when ok then ts end ignore nulls) over w as fetched_at,
          sum(case when good then 1 else 0 end) over w as g
          from flagged window w as (partition by client order by ts, poll_id rows unbounded preceding)),
        counted as (select *, cast(sum(case when good then 0 else 1 end) over
            (partition by client, g order by ts, poll_id rows unbounded preceding) as integer) as errors_in_row from grp)
        select poll_id, m0 as state_mode, state_etag, fetched_at, errors_in_row,
          case when errors_in_row = 0 then 45000.0::double
               else least(45000 * pow(2, errors_in_row), 300000)::double end as next_poll_ms from counted""",
}
