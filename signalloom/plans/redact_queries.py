"""Redaction queries over documents, pages, conversations and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions import redact as R
from signalloom.operators.nested import scrub_json, scrub_nested, scrub_object, scrub_once_at_sink
from signalloom.plans.views import table, view

# --- oracle text -------------------------------------------------------------

_SPACE = r"\t\n\x0b\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
_WORDS = "api[_-]?key|api[_-]?secret|secret|password|passwd|pwd|token|auth(?:orization)?|jwt"


def sql_cut(c: str) -> str:
    return f"""case when length({c}) > 8192
      then substr({c}, 1, 8192) || '... [truncated ' || (length({c}) - 8192) || ' chars]' else {c} end"""


def sql_jwt(c: str) -> str:
    return f"regexp_replace({c}, 'eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+', '[REDACTED_JWT]', 'g')"


def sql_bearer(c: str) -> str:
    return f"regexp_replace({c}, '(?i)bearer[{_SPACE}]+[A-Z0-9._~+/-]+=*', '[REDACTED_BEARER]', 'g')"


def sql_key_values(c: str) -> str:
    quote = "\"''"
    return (
        f"regexp_replace({c}, '(?i)({_WORDS})([{quote}{_SPACE}:=]+)([^{quote}{_SPACE},}}\\]]+)',"
        " '\\1\\2[REDACTED]', 'g')"
    )


def sql_emails(c: str) -> str:
    return f"regexp_replace({c}, '([A-Za-z0-9._%+-]+)@([A-Za-z0-9.-]+\\.[A-Za-z]{{2,}})', '*@\\2', 'g')"


def sql_cards(c: str) -> str:
    digit = "cast(substr(reverse(d), i, 1) as integer)"
    luhn = f"""list_sum(list_transform(range(1, length(d) + 1), lambda i:
        case when i % 2 = 1 then {digit} when {digit} > 4 then 2 * {digit} - 9 else 2 * {digit} end)) % 10 = 0"""
    return f"""array_to_string(list_transform(
      list_zip(regexp_split_to_array({c}, '\\b[0-9]{{13,19}}\\b'),
               list_transform(regexp_extract_all({c}, '\\b[0-9]{{13,19}}\\b'),
                              lambda d: case when {luhn} then '[REDACTED_CARD]' else d end)),
      lambda z: z[1] || coalesce(z[2], '')), '')"""


def sql_scrub(table_sql: str, keys: str, c: str) -> str:
    """R1 step by step, as one CTE per rule; the result column is ``clean``."""
    steps = [sql_cut, sql_jwt, sql_bearer, sql_key_values, sql_emails, sql_cards]
    ctes = [f"s0 as materialized (select {keys}, {c} as t from {table_sql})"]
    for i, step in enumerate(steps):
        ctes.append(f"s{i + 1} as materialized (select {keys}, {step('t')} as t from s{i})")
    return ", ".join(ctes)


_DOC_STEPS = sql_scrub("documents", "doc_id", "text")

# --- queries -----------------------------------------------------------------


def _docs(fn):
    """One rule over all documents; texts are compared by digest and length."""
    return lambda s, d: (
        table(s, d, "documents")
        .select("doc_id", fn(F.col("text")).alias("clean"))
        .select("doc_id", F.md5("clean").alias("digest"), F.char_length("clean").alias("n"))
    )


def _docs_sql(expr: str, source: str = "documents") -> str:
    return f"""select doc_id, md5(clean) as digest, cast(length(clean) as integer) as n
      from (select doc_id, {expr} as clean from {source})"""


_WITH_JWT = "concat(text, ' eyJ', md5(cast(doc_id as string)), '.', lang, '.', md5(source), ' end')"
_WITH_BEARER = "concat(text, ' BEARER  ', md5(cast(doc_id as string)), '== end')"


def _extended(extra: str, fn):
    return lambda s, d: (
        table(s, d, "documents")
        .selectExpr("doc_id", f"{extra} as t")
        .select("doc_id", fn(F.col("t")).alias("clean"))
        .select("doc_id", F.md5("clean").alias("digest"), F.char_length("clean").alias("n"))
    )


def redacted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(R.scrub_string)(spark, sf_dir)


_MAIL = """case when event_id % 3 = 0 then concat('user.', cast(user_id as string), '@mail.example.com')
  when event_id % 3 = 1 then concat('write to user', cast(user_id as string), '@mail.example.com now')
  else concat('token=', cast(event_id as string)) end"""

# field names that producers use, with the id in some of them
_NAME = """case event_id % 16 when 0 then 'password' when 1 then 'db_pwd' when 2 then 'x-pwd' when 3 then 'userSecretValue'
  when 4 then 'auth_header' when 5 then 'Authorization' when 6 then 'api-key' when 7 then 'my api_key here'
  when 8 then 'apiKeyHash' when 9 then 'SESSION_ID' when 10 then 'cookie' when 11 then 'cookies'
  when 12 then 'contactEmail' when 13 then 'jwt' when 14 then concat('field', cast(user_id as string))
  else 'x-api-secret' end"""
_SECRET_SQL = """regexp_matches(name, '(?i)password|passwd|secret|token|apikey|apisecret|set-cookie|session|x-api-key')
  or regexp_matches(name, '(?i)\\b(pwd|auth|authorization|api[_-]?key|api[_-]?secret|jwt|cookie)\\b')"""

_DB_ERROR = """concat('  FATAL: could not connect to postgres://u', cast(event_id as string), ':p@db.example.com/app?x=1 ',
  'PGPASSWORD = s', cast(user_id as string), ' after ', props, repeat('.', cast(event_id % 1500 as int)), '  ')"""


def _events(name: str, expr: str, fn):
    return lambda s, d: table(s, d, "events").selectExpr("event_id", f"{expr} as x").select(
        "event_id", fn(F.col("x")).alias(name)
    )


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr(_NAME)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.create_map(
            name, F.col("event_type"), F.lit("note"), F.expr(_MAIL), F.lit("userEmail"), F.expr(_MAIL)
        ).alias("attributes"),
    )


def scrub_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _attributes(spark, sf_dir)
    out = rows.select("event_id", scrub_object("attributes", rows.schema["attributes"].dataType).alias("m"))
    return out.select(
        "event_id",
        F.element_at(F.map_values("m"), 1).alias("first_value"),
        F.col("m")["note"].alias("note"),
        F.col("m")["userEmail"].alias("user_email"),
    )


def scrub_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document as a nested record, redacted from its schema."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct(
            "text",
            F.col("source").alias("api_token"),
            F.struct(F.col("lang").alias("lang"), F.concat("source", F.lit("@corp.example.com")).alias("ownerEmail")).alias("who"),
            F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 150 + 1).cast("int")), lambda i: i.cast("string")).alias("parts"),
        ).alias("record"),
    )
    out = scrub_nested(rows, keep=("doc_id",))
    return out.select(
        "doc_id",
        F.md5("record.text").alias("digest"),
        F.col("record.api_token").alias("api_token"),
        F.col("record.who.lang").alias("lang"),
        F.col("record.who.ownerEmail").alias("owner_email"),
        F.size("record.parts").alias("n_parts"),
        F.element_at("record.parts", -1).alias("last_part"),
    )


def scrub_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same record as JSON text of unknown shape."""
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.to_json(
            F.struct(
                "text",
                F.struct("source", F.struct(F.struct(F.struct(F.struct("lang").alias("e")).alias("d")).alias("c")).alias("b")).alias("a"),
                F.col("n_chars").alias("session_chars"),
                F.col("n_chars"),
            )
        ).alias("payload"),
    )
    clean = rows.select("doc_id", scrub_json("payload").alias("payload"))
    parsed = F.from_json(
        "payload",
        "text string, session_chars string, n_chars long, a struct<source:string,b:struct<c:struct<d:string>>>",
    )
    return clean.select("doc_id", parsed.alias("p")).select(
        "doc_id",
        F.md5("p.text").alias("digest"),
        "p.session_chars",
        "p.n_chars",
        F.col("p.a.source").alias("source"),
        F.col("p.a.b.c.d").alias("deep"),
    )


def scrubbed_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redact at the sink, and once more as a later stage would: nothing changes any more."""
    rows = view(spark, sf_dir, "telemetry").select("event_id", "message", "metadata_json")
    once = scrub_once_at_sink(rows, ("metadata_json",), keep=("event_id",))
    again = scrub_once_at_sink(once.withColumnRenamed("message", "once"), ("metadata_json",), keep=("event_id",))
    return again.select("event_id", F.col("once").alias("message"), F.get_json_object("metadata_json", "$.k").alias("k"))


QUERIES = {
    "R1_scrub_string": redacted_documents,
    "R1_scrub_pages": lambda s, d: table(s, d, "pages").select("page_id", F.md5(R.scrub_string("html")).alias("digest")),
    "R1_scrub_conversations": lambda s, d: table(s, d, "conversations").select(
        "conv_id", "turn", F.md5(R.scrub_string("text")).alias("digest")
    ),
    "R1a_length_cut": _docs(R.cut_long),
    "R1b_jwt": _extended(_WITH_JWT, R.redact_jwt),
    "R1c_bearer": _extended(_WITH_BEARER, R.redact_bearer),
    "R1d_key_value": _docs(R.redact_key_values),
    "R1e_email": _docs(R.mask_emails),
    "R1f_cards": _docs(R.redact_cards),
    "R2_mask_email": _events("masked", _MAIL, R.mask_email),
    "R3_secret_key": _events("secret", _NAME, R.is_secret_key),
    "R4_mask_key": _events("masked_key", _NAME, R.is_mask_key),
    "R5_scrub_nested": scrub_records,
    "R5_scrub_map": scrub_map,
    "R5_scrub_json": scrub_json_records,
    "R6_scrub_object": lambda s, d: _attributes(s, d).select(
        "event_id",
        scrub_object(
            F.when(F.col("event_id") % 4 > 0, F.struct(F.col("attributes")["note"].alias("note"), F.lit("x").alias("cookie"))),
            _attributes(s, d).select(F.struct(F.col("attributes")["note"].alias("note"), F.lit("x").alias("cookie")).alias("o")).schema["o"].dataType,
        ).alias("o"),
    ).select("event_id", "o.note", "o.cookie", F.col("o").isNull().alias("absent")),
    "R7_db_errors": _events("message", _DB_ERROR, R.scrub_db_errors),
    "R8_scrub_once": scrubbed_telemetry,
}

_MASK_SQL = f"""case when regexp_full_match(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{{2,}}')
  then regexp_replace(x, '^[^@]+@', '*@') else {sql_emails(sql_key_values('x'))} end"""
_NOTE_SQL = sql_emails(sql_key_values("x"))

ORACLE = {
    "R1_scrub_string": f"with {_DOC_STEPS} select doc_id, md5(t) as digest, cast(length(t) as integer) as n from s6",
    "R1_scrub_pages": f"with {sql_scrub('pages', 'page_id', 'html')} select page_id, md5(t) as digest from s6",
    "R1_scrub_conversations": f"""with {sql_scrub('conversations', 'conv_id, turn', 'text')}
        select conv_id, turn, md5(t) as digest from s6""",
    "R1a_length_cut": _docs_sql(sql_cut("text")),
    "R1b_jwt": _docs_sql(sql_jwt(_WITH_JWT)),
    "R1c_bearer": _docs_sql(sql_bearer(_WITH_BEARER)),
    "R1d_key_value": _docs_sql(sql_key_values("text")),
    "R1e_email": _docs_sql(sql_emails("text")),
    "R1f_cards": _docs_sql(sql_cards("text")),
    "R2_mask_email": f"select event_id, {_MASK_SQL} as masked from (select event_id, {_MAIL} as x from events)",
    "R3_secret_key": f"select event_id, {_SECRET_SQL} as secret from (select event_id, {_NAME} as name from events)",
    "R4_mask_key": f"""select event_id, contains(lower(name), 'email') as masked_key
        from (select event_id, {_NAME} as name from events)""",
    "R5_scrub_nested": f"""with {_DOC_STEPS}
        select doc_id, md5(s6.t) as digest, '[REDACTED]' as api_token, lang,
          '*@corp.example.com' as owner_email,
          cast(least(doc_id % 150 + 1, 101) as integer) as n_parts,
          case when doc_id % 150 + 1 > 100 then '[+' || (doc_id % 150 + 1 - 100) || ' more]'
               else cast(doc_id % 150 + 1 as varchar) end as last_part
        from documents join s6 using (doc_id)""",
    "R5_scrub_map": f"""select event_id,
          case when {_SECRET_SQL} then '[REDACTED]' else event_type end as first_value,
          {_NOTE_SQL} as note, {_MASK_SQL} as user_email
        from (select event_id, event_type, {_NAME} as name, {_MAIL} as x from events)""",
    "R5_scrub_json": f"""with {_DOC_STEPS}
        select doc_id, md5(s6.t) as digest, '[REDACTED]' as session_chars, n_chars, source, '{{"e":"[MaxDepth]"}}' as deep
        from documents join s6 using (doc_id)""",
    "R6_scrub_object": f"""select event_id, case when event_id % 4 > 0 then {_NOTE_SQL} end as note,
          case when event_id % 4 > 0 then '[REDACTED]' end as cookie, event_id % 4 = 0 as absent
        from (select event_id, {_MAIL} as x from events)""",
    "R7_db_errors": f"""select event_id, substr(trim(regexp_replace(regexp_replace(x,
          '(?i)postgres(ql)?://[^\\s"'']+', 'postgresql://***', 'g'), '(?i)(pgpassword|password)\\s*=\\s*\\S+', '\\1=***', 'g')),
          1, 1000) as message from (select event_id, {_DB_ERROR} as x from events)""",
    "R8_scrub_once": f"""select event_id, {sql_emails(sql_key_values('message'))} as message,
          props ->> '$.k' as k from (select event_id, message, metadata_json as props from $telemetry)""",
}
