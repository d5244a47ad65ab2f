"""Signing and verifying bodies (H2-H4).

Secrets live in a table ``key_id, secret``.  The two padded keys of a secret
are computed once per secret on that side of the join, the rest is two hashes
per body in the JVM, and no secret is ever a literal of the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalloom.functions.hashing import hmac_pads, hmac_with_pads
from signalloom.limits import REPLAY_WINDOW_SECONDS
from signalloom.operators.sizing import fits_broadcast

# Names of the fields that carry the signature inside a body.
KEY_FIELD, TIME_FIELD, SIGNATURE_FIELD = "__key", "__ts", "__sig"
_TEXT = '"([^"]*)"'
EMBEDDED = (
    rf'(?s)\A(\{{.*?),?"{KEY_FIELD}":{_TEXT},"{TIME_FIELD}":{_TEXT},"{SIGNATURE_FIELD}":{_TEXT}\}}\z'
)


def _with_pads(df: DataFrame, secrets: DataFrame, key: str) -> DataFrame:
    side = secrets.select(F.col("key_id").alias("__kid"), hmac_pads("secret").alias("__pads"))
    if fits_broadcast(secrets):
        side = F.broadcast(side)
    return df.join(side, F.col(key) == F.col("__kid"), "left")


def _signature(ts: Column, body: Column) -> Column:
    signed = F.concat(ts.cast("string"), F.lit("."), body)
    return F.concat(F.lit("v1="), hmac_with_pads("__pads", signed))


def sign_bodies(
    df: DataFrame, secrets: DataFrame, ts: str | Column, body: str = "body", key: str = "key_id"
) -> DataFrame:
    """H2: adds ``signature`` and ``timestamp`` (whole seconds, as text)."""
    at = F.col(ts) if isinstance(ts, str) else ts
    return (
        _with_pads(df, secrets, key)
        .withColumns({"timestamp": at.cast("string"), "signature": _signature(at, F.col(body))})
        .drop("__kid", "__pads")
    )


def verify_bodies(
    df: DataFrame,
    secrets: DataFrame,
    now: Column,
    body: str = "body",
    key: str = "key_id",
    window: int = REPLAY_WINDOW_SECONDS,
) -> DataFrame:
    """H3: adds ``signature_status``: ok, unknown_key, stale or bad_signature.

    ``now`` is in seconds, like ``timestamp``.
    """
    good = F.col("signature") == _signature(F.col("timestamp"), F.col(body))
    age = F.abs(now.cast("long") - F.col("timestamp").try_cast("long"))
    status = (
        F.when(F.col("__pads").isNull(), "unknown_key")
        .when(~F.coalesce(good, F.lit(False)), "bad_signature")
        .when(~F.coalesce(age <= window, F.lit(False)), "stale")
        .otherwise("ok")
    )
    return _with_pads(df, secrets, key).withColumn("signature_status", status).drop("__kid", "__pads")


def embed_signature(df: DataFrame, body: str = "body", key: str = "key_id") -> DataFrame:
    """A signed body with key, time and signature as its last three fields."""
    fields = F.concat(
        *[
            part
            for name, col in ((KEY_FIELD, key), (TIME_FIELD, "timestamp"), (SIGNATURE_FIELD, "signature"))
            for part in (F.lit(f',"{name}":"'), F.col(col), F.lit('"'))
        ]
    )
    head = F.regexp_replace(body, r"\}\z", "")
    fields = F.when(head == "{", F.substring(fields, 2, 1 << 30)).otherwise(fields)
    return df.withColumn(body, F.concat(head, fields, F.lit("}")))


def verify_embedded(df: DataFrame, secrets: DataFrame, now: Column, body: str = "body") -> DataFrame:
    """H4: verify bodies that carry their signature inside.

    The signature covers the body without its last three fields.  They are
    cut off as text, so the rest stays byte-exact.  Bodies without them get
    the status ``unsigned``.
    """
    def part(i: int) -> Column:
        return F.regexp_extract(body, EMBEDDED, i)

    opened = df.withColumn("__signed", F.coalesce(F.col(body).rlike(EMBEDDED), F.lit(False))).withColumns(
        {
            "__body": F.when(F.col("__signed"), F.concat(part(1), F.lit("}"))),
            "__key": F.when(F.col("__signed"), part(2)),
            "timestamp": F.when(F.col("__signed"), part(3)),
            "signature": F.when(F.col("__signed"), part(4)),
        }
    )
    checked = verify_bodies(opened, secrets, now, "__body", "__key")
    return checked.withColumn(
        "signature_status", F.when(F.col("__signed"), F.col("signature_status")).otherwise("unsigned")
    ).drop("__signed", "__body", "__key")
