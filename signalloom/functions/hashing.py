"""Signatures, fingerprints and the schedule jitter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _xor_pad(key_hex: Column, byte: int) -> Column:
    """64 bytes: the zero-padded key with every byte xor-ed."""
    padded = F.rpad(key_hex, 2 * _BLOCK, "0")
    octets = F.transform(
        F.sequence(F.lit(1), F.lit(2 * _BLOCK - 1), F.lit(2)),
        lambda i: F.lpad(
            F.hex(F.conv(padded.substr(i, F.lit(2)), 16, 10).cast("int").bitwiseXOR(F.lit(byte))), 2, "0"
        ),
    )
    return F.unhex(F.array_join(octets, ""))


def hmac_pads(secret: Column | str) -> Column:
    """The two padded keys of an HMAC-SHA256 secret as ``struct<inner, outer>``.

    Work that depends on the secret alone, so it belongs on the (small) table
    of secrets rather than on every body.
    """
    raw = F.encode(_col(secret), "UTF-8")
    key_hex = F.when(F.octet_length(raw) > _BLOCK, F.sha2(raw, 256)).otherwise(F.lower(F.hex(raw)))
    return F.struct(_xor_pad(key_hex, 0x36).alias("inner"), _xor_pad(key_hex, 0x5C).alias("outer"))


def hmac_with_pads(pads: Column | str, body: Column | str) -> Column:
    pads = _col(pads)
    inner = F.sha2(F.concat(pads["inner"], F.encode(_col(body), "UTF-8")), 256)
    return F.sha2(F.concat(pads["outer"], F.unhex(inner)), 256)


def hmac_sha256_hex(secret: Column | str, body: Column | str) -> Column:
    """H1: HMAC-SHA256 in lower-case hex; ``secret`` is a column.

    A literal secret would be printed by ``explain``; the operators in
    ``operators.signing`` therefore join secrets in from a table.
    """
    return hmac_with_pads(hmac_pads(secret), body)


def jitter_minutes(seed: Column | str) -> Column:
    """B2: 0 to 59, from the rolling hash h = h * 31 + unit (mod 2**32).

    Units are UTF-16 code units, as the producers of the seed count them.
    """
    units = F.hex(F.encode(_col(seed), "UTF-16BE"))
    numbers = F.transform(
        F.sequence(F.lit(0), (F.length(units) / 4).cast("int") - 1),
        lambda i: F.conv(units.substr(i * 4 + 1, F.lit(4)), 16, 10).cast("long"),
    )
    h = F.aggregate(numbers, F.lit(0).cast("long"), lambda a, u: F.pmod(a * 31 + u, F.lit(1 << 32)))
    return F.when(F.length(units) > 0, F.pmod(h, F.lit(60)).cast("int")).when(units == "", F.lit(0))


KEY_PATTERN = r"\A[0-9a-fA-F]{64}\z"


def valid_key(key_hex: Column | str) -> Column:
    """64 hexadecimal digits."""
    return F.coalesce(_col(key_hex).rlike(KEY_PATTERN), F.lit(False))


def key_fingerprint(key_hex: Column | str) -> Column:
    """First 16 hex digits of SHA-256 over the key bytes, null for a malformed key."""
    c = _col(key_hex)
    return F.when(valid_key(c), F.substring(F.sha2(F.unhex(c), 256), 1, 16))


def unit_interval(key: Column | str) -> Column:
    """A number in [0, 1) that depends on the key alone; the same in any engine with MD5."""
    return F.conv(F.substring(F.md5(_col(key).cast("string")), 1, 8), 16, 10).cast("double") / (1 << 32)
