"""Event and validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions import text as X
from signalloom.functions.net import os_family
from signalloom.operators import events as E
from signalloom.plans.redact_queries import sql_cut, sql_emails, sql_key_values, sql_scrub
from signalloom.plans.views import table, view

NOW = "2024-01-31 02:10:00"


def _now():
    return F.lit(NOW).cast("timestamp_ntz")

_NOW_ISO = "2024-01-31T02:10:00.000Z"


def _clean(c: str) -> str:
    """R1 on the short messages of the telemetry view (no cut, JWT, bearer or card in them)."""
    return sql_emails(sql_key_values(c))


def _kind(s: SparkSession, d: str, kind: str) -> DataFrame:
    return view(s, d, "telemetry").filter(F.col("type") == kind)


def normalize_log(s: SparkSession, d: str) -> DataFrame:
    rows = _kind(s, d, "log").withColumn("level", F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("level")))
    return E.normalize_log(rows, metadata="metadata_json", now=_now()).select(
        "event_id", "level", "source", "message", "timestamp", F.get_json_object("metadata_json", "$.k").alias("k")
    )


# errors: every 4th was thrown, every 3rd has a type, some a long stack
_ERRORS = """select event_id, user_id, message,
  case when event_id % 3 = 0 then 'NETWORK' when event_id % 3 = 1 then '' end as error_type,
  case when event_id % 5 = 0 then 'CRITICAL' end as severity,
  case when event_id % 2 = 0 then concat('at f (https://x.example.com/?token=', cast(event_id as string), ') ',
       repeat('s', cast((event_id * 53) % 14000 as int))) end as stack,
  concat('Err', cast(event_id % 9 as string)) as name, metadata_json
from telemetry where type = 'error'"""


def _errors(s: SparkSession, d: str) -> DataFrame:
    return s.sql(_ERRORS.replace("from telemetry", "from {t}"), t=view(s, d, "telemetry"))


def normalize_error(s: SparkSession, d: str) -> DataFrame:
    out = E.normalize_error(_errors(s, d), "metadata_json", exception=F.col("event_id") % 4 == 0, now=_now())
    return out.select(
        "event_id", "error_type", "severity", "message", F.md5("stack").alias("stack_digest"), "metadata_json", "timestamp"
    )


def normalize_debug(s: SparkSession, d: str) -> DataFrame:
    rows = _kind(s, d, "debug").withColumn("debug_type", F.when(F.col("event_id") % 2 == 0, F.col("source")))
    return E.normalize_debug(rows, now=_now()).select("event_id", "debug_type", "timestamp", "message")


def normalize_security(s: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 == 0, "BRUTE_FORCE").when(F.col("event_id") % 3 == 1, "")
    return E.normalize_security(_kind(s, d, "security").withColumn("security_type", kind)).select(
        "event_id", "security_type", "message"
    )


def enriched(s: SparkSession, d: str) -> DataFrame:
    hosts = table(s, d, "nation").select(
        F.col("n_nationkey").cast("long").alias("host_id"), F.concat(F.lit("host-"), "n_name").alias("hostname")
    )
    rows = view(s, d, "telemetry").withColumn("host_id", F.col("user_id") % 30)
    out = E.enrich_context(
        rows,
        {"environment": "production", "release": "1.2.3", "runtime": "node"},
        tags={"team": "a", "region": "eu"},
        global_context={"region": "us", "plan": "x"},
        hosts=hosts,
        now=_now(),
    )
    m = F.col("_meta")
    return out.select(
        "event_id",
        m["timestamp"].alias("captured"),
        m["context"]["environment"].alias("environment"),
        m["context"]["hostname"].alias("hostname"),
        m["context"]["tags"]["region"].alias("region"),
        F.to_json(m["context"]["tags"]).alias("tags"),
    )


def merged_tags(s: SparkSession, d: str) -> DataFrame:
    tags = F.create_map(F.lit("type"), "type", F.lit("who"), F.col("user_id").cast("string"))
    extra = F.when(F.col("event_id") % 3 > 0, F.create_map(F.lit("source"), "source", F.lit("who"), F.lit("all")))
    out = view(s, d, "telemetry").select("event_id", E.merge_tags(tags, extra).alias("m"))
    keys = F.array_join(F.map_keys("m"), ",")
    return out.select("event_id", keys.alias("keys"), F.col("m")["who"].alias("who"), F.col("m")["source"].alias("source"))


def user_context(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_custkey").cast("string").alias("id"),
            F.concat(F.lower("c_mktsegment"), F.lit("."), F.col("c_custkey").cast("string"), F.lit("@shop.example.com")).alias("email"),
            F.col("c_name").alias("name"),
            F.col("c_acctbal").alias("session_balance"),
            F.concat(F.lit("pwd: "), "c_name").alias("note"),
        ).alias("user"),
    )
    return E.user_context(rows).select("c_custkey", "user.*")


def _hook(event: dict) -> dict | bool:
    if event["event_id"] % 10 == 0:
        return False
    if event["event_id"] % 10 == 1:
        raise ValueError("hook failed")
    return {**event, "message": event["message"].upper()}


def hooked(s: SparkSession, d: str) -> DataFrame:
    return E.before_send(view(s, d, "telemetry").select("event_id", "message"), _hook)


def chained(s: SparkSession, d: str) -> DataFrame:
    chain = E.StageChain(
        lambda df: df.filter("type <> 'debug'"),
        lambda df: df.withColumn("message", F.upper("message")),
    ).use(lambda df: df.filter("event_id % 2 = 0").withColumn("message", F.concat("message", F.lit("!"))))
    return chain.run(view(s, d, "telemetry").select("event_id", "type", "message"))


def console(s: SparkSession, d: str) -> DataFrame:
    calls = table(s, d, "conversations").select(
        "conv_id",
        "turn",
        F.array("text", F.concat(F.lit("password"), F.lit("")), F.concat(F.lit("= s"), F.col("turn").cast("string"))).alias("args"),
        F.element_at(F.array(*[F.lit(x) for x in ("error", "warn", "log", "debug", "table")]), (F.col("turn") % 5 + 1).cast("int")).alias("console_level"),
    )
    return E.console_to_events(calls).select("conv_id", "turn", "level", F.md5("message").alias("digest"), "metadata")


def crashes(s: SparkSession, d: str) -> DataFrame:
    base = _errors(s, d).select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("message")).alias("message"),
        F.col("stack"),
        "name",
        F.concat(F.lit("app"), F.col("user_id").cast("string"), F.lit(".js")).alias("filename"),
        (F.col("event_id") % 100).alias("lineno"),
        (F.col("event_id") % 7).alias("colno"),
    )
    out = None
    for runtime, kind, rest in (("browser", "error", 0), ("node", "error", 1), ("node", "rejection", 2)):
        part = E.crash_to_events(base.filter(F.col("event_id") % 3 == rest), runtime, kind).select(
            "event_id", "severity", "message", "stack", "metadata"
        )
        out = part if out is None else out.unionByName(part)
    return out


_UA = """case event_id % 7 when 0 then 'Mozilla/5.0 (Windows NT 10.0)' when 1 then 'Mozilla/5.0 (Macintosh; Intel Mac OS X)'
  when 2 then 'Mozilla/5.0 (X11; Linux)' when 3 then 'Mozilla/5.0 (Linux; Android 14)'
  when 4 then 'Mozilla/5.0 (iPhone; CPU iPhone OS 17 like Mac OS X)' when 5 then concat('iPad app ', cast(user_id as string))
  else concat('curl/', cast(user_id as string)) end"""

# tags: up to 26 entries, some with keys and values that are too long
_TAG_COUNT = "cast(event_id % 26 + 1 as int)"
_LONG = "repeat('k', case when event_id % 5 = 0 then 70 else 3 end)"


def clamped_tags(s: SparkSession, d: str) -> DataFrame:
    entries = F.expr(
        f"""transform(sequence(1, {_TAG_COUNT}), i -> struct(
          case when i > 2 then concat('t', cast(i as string)) else concat({_LONG}, cast(i as string)) end as key,
          repeat('v', cast((event_id + i) % 90 as int)) as value))"""
    )
    out = table(s, d, "events").select("event_id", X.clamp_tags(F.map_from_entries(entries)).alias("m"))
    return out.select(
        "event_id",
        F.size("m").alias("n"),
        F.array_join(F.map_keys("m"), ",").alias("keys"),
        F.array_join(F.map_values("m"), ",").alias("vals"),
    )


def objects_only(s: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).when(
        F.col("event_id") % 5 == 1, F.lit("[1,2]")
    ).when(F.col("event_id") % 5 == 2, F.lit(None)).otherwise(
        F.to_json(F.struct(F.lit("log").alias("type"), F.struct(F.col("event_type").alias("message")).alias("data")))
    )
    good, _bad = E.filter_object_events(table(s, d, "events").select("event_id", raw.alias("value")))
    return good.select("event_id", "event.type", F.col("event.data.message").alias("message"))


_BODY = "repeat(text, 12)"


def gated(s: SparkSession, d: str) -> DataFrame:
    sized = table(s, d, "documents").selectExpr("doc_id", f"{_BODY} as body")
    out = None
    for mode in ("fetch", "beacon"):
        for verdict, part in zip(("fits", "too_large"), X.size_gate(sized, "body", mode), strict=True):
            rows = part.select("doc_id", F.lit(mode).alias("mode"), F.lit(verdict).alias("verdict"))
            out = rows if out is None else out.unionByName(rows)
    return out


def merged_settings(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "events").select(
        "event_id",
        F.struct(F.lit("a").alias("name"), F.struct(F.lit(1).alias("x"), F.lit(2).alias("y")).alias("opts"), F.array(F.lit(1)).alias("list")).alias("base"),
        F.struct(
            F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("name"),
            F.struct(F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("int")).alias("y"), F.lit(9).alias("z")).alias("opts"),
            F.when(F.col("event_id") % 5 == 0, F.array(F.lit(7), F.lit(8))).alias("list"),
        ).alias("over"),
    )
    m = X.deep_merge(F.col("base"), F.col("over"), rows.schema["base"].dataType, rows.schema["over"].dataType)
    return rows.select("event_id", m.alias("m")).select(
        "event_id", "m.name", "m.opts.x", "m.opts.y", "m.opts.z", F.array_join(F.col("m.list").cast("array<string>"), ",").alias("items")
    )


QUERIES = {
    "P1_normalize_log": normalize_log,
    "P2_normalize_error": normalize_error,
    "P3_normalize_debug": normalize_debug,
    "P4_normalize_security": normalize_security,
    "P5_with_level": lambda s, d: E.with_level(view(s, d, "telemetry"), "WARN").select("event_id", "level"),
    "P6_filter_min_level": lambda s, d: E.filter_min_level(view(s, d, "telemetry"), "WARN").select("event_id", "type", "level"),
    "P7_sample_events": lambda s, d: E.sample_events(view(s, d, "telemetry"), 0.3, by="event_id").select("event_id", "type"),
    "P8_enrich_context": enriched,
    "P9_merge_tags": merged_tags,
    "P10_user_context": user_context,
    "P11_before_send": hooked,
    "P12_middleware_chain": chained,
    "P13_console_events": console,
    "P14_crash_events": crashes,
    "P15_flag_immediate": lambda s, d: E.flag_immediate(
        view(s, d, "telemetry").withColumn("severity", F.when(F.col("event_id") % 4 == 0, "CRITICAL"))
    ).select("event_id", "immediate"),
    "P16_os_family": lambda s, d: table(s, d, "events").selectExpr("event_id", f"{_UA} as ua").select(
        "event_id", os_family("ua").alias("os"), os_family("ua", strict_order=False).alias("os_mobile_first")
    ),
    "P17_classify_status": lambda s, d: view(s, d, "sent").select(
        "event_id", E.classify_status("status").alias("alone"), E.classify_status("status", True).alias("in_batch")
    ),
    "V1_clamp_message": lambda s, d: table(s, d, "documents").select("doc_id", F.md5(X.clamp_message("text")).alias("digest")),
    "V2_clamp_metadata": lambda s, d: table(s, d, "documents").select(
        "doc_id", F.md5(X.clamp_metadata(F.to_json(F.struct("n_chars", F.regexp_replace("text", "[^a-zA-Z ]", "").alias("text"))))).alias("digest")
    ),
    "V3_clamp_tags": clamped_tags,
    "V4_filter_objects": objects_only,
    "V5_size_gate": gated,
    "V6_json_size": lambda s, d: table(s, d, "documents").select(
        "doc_id", X.json_size(F.struct("n_chars", F.regexp_replace("text", "[^\\p{L} ]", "").alias("text"))).alias("n_bytes")
    ),
    "U1_truncate": lambda s, d: table(s, d, "documents").select("doc_id", F.md5(X.truncate_text("text")).alias("digest")),
    "U2_parse_json": lambda s, d: table(s, d, "events").select(
        "event_id",
        X.parse_json(
            F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("props")),
            "k long",
            F.struct(F.lit(-1).cast("long").alias("k")),
        ).alias("p"),
    ).select("event_id", F.coalesce("p.k", F.lit(-1)).alias("k")),
    "U3_json_text": lambda s, d: table(s, d, "events").select(
        "event_id", X.json_text(F.struct("event_id", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("kind"))).alias("text")
    ),
    "U4_iso_time": lambda s, d: table(s, d, "events").select("event_id", X.iso_time("ts").alias("iso")),
    "U5_deep_merge": merged_settings,
    "U6_stack_or_summary": lambda s, d: _errors(s, d).select(
        "event_id", F.md5(X.stack_or_summary("stack", "name", "message")).alias("digest")
    ),
}

_ERR = f"err as ({_ERRORS.replace('from telemetry', 'from $telemetry')})"


def _scrub_stack(c: str) -> str:
    # the length cut comes first, then the rules that can match in a stack
    return sql_key_values(f"({sql_cut(c)})")


ORACLE = {
    "P1_normalize_log": f"""select event_id,
          case when event_id % 7 = 0 then 'INFO' else coalesce(level, 'INFO') end as level,
          coalesce(source, 'app') as source, {_clean('message')} as message, '{_NOW_ISO}' as timestamp,
          metadata_json ->> '$.k' as k from $telemetry where type = 'log'""",
    "P2_normalize_error": f"""with {_ERR}
        select event_id, case when event_id % 4 = 0 then 'RUNTIME' else coalesce(nullif(error_type, ''), 'UNKNOWN') end as error_type,
          case when event_id % 4 = 0 then 'MEDIUM' else coalesce(severity, 'MEDIUM') end as severity,
          {_clean('message')} as message,
          md5({_scrub_stack("case when event_id % 4 = 0 and stack is null then name || ': ' || message else stack end")}) as stack_digest,
          case when event_id % 4 = 0 then '{{"name":"' || name || '"}}' else replace(metadata_json, ' ', '') end as metadata_json,
          '{_NOW_ISO}' as timestamp from err""",
    "P3_normalize_debug": f"""select event_id, coalesce(case when event_id % 2 = 0 then source end, 'unknown') as debug_type,
          '{_NOW_ISO}' as timestamp, message from $telemetry where type = 'debug'""",
    "P4_normalize_security": """select event_id, case when event_id % 3 = 0 then 'BRUTE_FORCE' else 'SUSPICIOUS_ACTIVITY' end
          as security_type, message from $telemetry where type = 'security'""",
    "P5_with_level": "select event_id, 'WARN' as level from $telemetry",
    "P6_filter_min_level": """select event_id, type, level from $telemetry
          where type <> 'log' or level in ('WARN', 'ERROR', 'FATAL')""",
    "P7_sample_events": """select event_id, type from $telemetry
          where ('0x' || substr(md5(cast(event_id as varchar)), 1, 8))::bigint / 4294967296.0 < 0.3""",
    "P8_enrich_context": f"""select event_id, '{_NOW_ISO}' as captured, 'production' as environment,
          case when n_name is not null then 'host-' || n_name end as hostname, 'us' as region,
          '{{"team":"a","region":"us","plan":"x"}}' as tags
        from $telemetry left join nation on n_nationkey = user_id % 30""",
    "P9_merge_tags": """select event_id, case when event_id % 3 > 0 then 'type,who,source' else 'type,who' end as keys,
          case when event_id % 3 > 0 then 'all' else cast(user_id as varchar) end as who,
          case when event_id % 3 > 0 then source end as source from $telemetry""",
    "P10_user_context": """select c_custkey, cast(c_custkey as varchar) as id, '*@shop.example.com' as email, c_name as name,
          '[REDACTED]' as session_balance, 'pwd: [REDACTED]' as note from customer""",
    "P11_before_send": """select event_id, case when event_id % 10 = 1 then message else upper(message) end as message
          from $telemetry where event_id % 10 <> 0""",
    "P12_middleware_chain": """select event_id, type, upper(message) || '!' as message from $telemetry
          where type <> 'debug' and event_id % 2 = 0""",
    "P13_console_events": f"""with base as (select conv_id, turn, text || ' password = s' || turn as joined from conversations),
        {sql_scrub('base', 'conv_id, turn', 'joined')}
        select conv_id, turn, case turn % 5 when 0 then 'ERROR' when 1 then 'WARN' when 3 then 'DEBUG' else 'INFO' end as level,
          md5(t) as digest, '{{"autoCapture":true,"consoleLevel":"' ||
          case turn % 5 when 0 then 'error' when 1 then 'warn' when 2 then 'log' when 3 then 'debug' else 'table' end || '"}}' as metadata
        from s6""",
    "P14_crash_events": f"""with {_ERR}, raw as (select event_id, user_id, name, event_id % 3 as r,
            case when event_id % 3 = 0 then '' else message end as m, stack as st from err)
        select event_id, case r when 1 then 'CRITICAL' else 'HIGH' end as severity,
          case r when 0 then 'Uncaught error' when 1 then {_clean('m')}
            else 'Unhandled Promise Rejection: ' || {_clean('m')} end as message,
          {_scrub_stack("(case when r = 0 and st is null then 'app' || user_id || '.js:' || event_id % 100 || ':' || event_id % 7 else st end)")} as stack,
          case r when 0 then '{{"filename":"app' || user_id || '.js","lineno":' || event_id % 100 || ',"colno":' || event_id % 7 || ',"autoCapture":true}}'
            when 1 then '{{"name":"' || name || '","autoCapture":true}}'
            else '{{"autoCapture":true,"type":"unhandledRejection"}}' end as metadata
        from raw""",
    "P15_flag_immediate": """select event_id, type = 'security' or (type = 'log' and coalesce(level, '') = 'FATAL')
          or (type = 'error' and event_id % 4 = 0) as immediate from $telemetry""",
    "P16_os_family": f"""select event_id,
          case event_id % 7 when 0 then 'Windows' when 1 then 'macOS' when 2 then 'Linux' when 3 then 'Linux'
            when 4 then 'macOS' when 5 then 'iOS' else 'Unknown' end as os,
          case event_id % 7 when 0 then 'Windows' when 1 then 'macOS' when 2 then 'Linux' when 3 then 'Android'
            when 4 then 'iOS' when 5 then 'iOS' else 'Unknown' end as os_mobile_first from events""",
    "P17_classify_status": """select event_id,
          case when status = 200 then 'ok' when status in (400, 404) then 'permanent' else 'retryable' end as alone,
          case when status = 200 then 'ok' when status = 400 then 'split' when status = 404 then 'permanent' else 'retryable' end as in_batch
          from $sent""",
    "V1_clamp_message": """select doc_id, md5(case when strlen(text) > 2048 then substr(text, 1, 2048) || '... [truncated]'
          else text end) as digest from documents""",
    "V2_clamp_metadata": f"""with j as (select doc_id, '{{"n_chars":' || n_chars || ',"text":"' ||
            regexp_replace(text, '[^a-zA-Z ]', '', 'g') || '"}}' as m from documents)
        select doc_id, md5(case when strlen(m) > 8192 then '{X.METADATA_DROPPED}' else m end) as digest from j""",
    "V3_clamp_tags": f"""with e as (select event_id, list_transform(range(1, least({_TAG_COUNT}, 20) + 1), lambda i: {{
            'k': substr(case when i > 2 then 't' || i else {_LONG} || i end, 1, 64),
            'v': substr(repeat('v', cast((event_id + i) % 90 as int)), 1, 64)}}) as es from events),
        u as (select event_id, unnest(es) as x, generate_subscripts(es, 1) as i from e),
        g as (select event_id, x.k as k, min(i) as first_i, arg_max(x.v, i) as v from u group by all)
        select event_id, cast(count(*) as integer) as n, string_agg(k, ',' order by first_i) as keys,
          string_agg(v, ',' order by first_i) as vals from g group by event_id""",
    "V4_filter_objects": """select event_id, 'log' as type, event_type as message from events where event_id % 5 >= 3""",
    "V5_size_gate": f"""select doc_id, mode, case when strlen({_BODY}) <= cap then 'fits' else 'too_large' end as verdict
        from documents, (values ('fetch', 262144), ('beacon', 65536)) as m(mode, cap)""",
    "V6_json_size": """select doc_id, cast(strlen(regexp_replace(text, '[^\\p{L} ]', '', 'g')) + strlen(cast(n_chars as varchar))
          + 22 as integer) as n_bytes from documents""",
    "U1_truncate": """select doc_id, md5(case when length(text) > 10000 then substr(text, 1, 10000) ||
          '... [truncated, total ' || length(text) || ' chars]' else text end) as digest from documents""",
    "U2_parse_json": """select event_id, case when event_id % 3 = 0 then -1 else (props ->> '$.k')::bigint end as k from events""",
    "U3_json_text": """select event_id, '{"event_id":' || event_id ||
          case when event_id % 2 = 0 then ',"kind":"' || event_type || '"' else '' end || '}' as text from events""",
    "U4_iso_time": "select event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as iso from events",
    "U5_deep_merge": """select event_id, case when event_id % 2 = 0 then event_type else 'a' end as name, 1 as x,
          cast(case when event_id % 3 = 0 then user_id else 2 end as integer) as y, 9 as z,
          case when event_id % 5 = 0 then '7,8' else '1' end as items from events""",
    "U6_stack_or_summary": f"""with {_ERR} select event_id, md5(coalesce(stack, name || ': ' || message)) as digest from err""",
}
