"""Explicit schemas of events and of the tables around them."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_TAGS = T.MapType(_S, _S)

CONTEXT = T.StructType(
    [T.StructField(n, _S) for n in ("environment", "release")]
    + [T.StructField("tags", _TAGS)]
    + [
        T.StructField(n, _S)
        for n in ("runtime", "os", "hostname", "userAgent", "url", "locale", "timezone", "screenResolution")
    ]
    + [
        T.StructField("memoryUsage", T.MapType(_S, _D)),
        T.StructField("nodeVersion", _S),
        T.StructField("pid", _L),
    ]
)
META = T.StructType(
    [
        T.StructField("sdkVersion", _S),
        T.StructField("timestamp", _S),
        T.StructField("context", CONTEXT),
        T.StructField("batchId", _S),
    ]
)
# Union of the four payload kinds; open objects stay JSON text.
DATA = T.StructType(
    [
        T.StructField(n, _S)
        for n in (
            "level",
            "message",
            "source",
            "type",
            "stack",
            "severity",
            "timestamp",
            "metadata",
            "data",
            "performance",
            "ipAddress",
            "userAgent",
            "country",
            "description",
        )
    ]
)
EVENT = T.StructType([T.StructField("type", _S), T.StructField("data", DATA), T.StructField("_meta", META)])

BLOCK_ENTRY = T.StructType([T.StructField(n, _S) for n in ("type", "value", "expiresAt")])
BLOCKLIST_SNAPSHOT = T.StructType(
    [
        T.StructField("mode", _S),
        T.StructField("entries", T.ArrayType(BLOCK_ENTRY)),
        T.StructField("fetchedAt", _L),
    ]
)
BACKUP_POLICY = T.StructType(
    [
        T.StructField("project_id", _S),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("intervalHours", _I),
        T.StructField("preferredHourUtc", _I),
        T.StructField("maxSizeMb", _I),
        T.StructField("runNowRequestedAt", _S),
        T.StructField("encryptionKeyFingerprint", _S),
        T.StructField("fetchedAt", _L),
    ]
)
# members of a state file and the columns they become
BACKUP_STATE_FIELDS = {
    "lastSuccessAt": "last_success_at",
    "lastAttemptAt": "last_attempt_at",
    "handledRunNowAt": "handled_run_now_at",
}
