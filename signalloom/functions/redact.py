"""Redaction of secrets and personal data in strings.

Everything here is a ``Column -> Column`` function built from JVM-side
expressions.  The same patterns are compiled by Python's ``re`` in
``scrub_text``, which the Arrow UDF for free-form JSON uses.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.limits import MAX_STRING_CHARS

# Markers.
REDACTED = "[REDACTED]"
REDACTED_CARD = "[REDACTED_CARD]"
REDACTED_JWT = "[REDACTED_JWT]"
REDACTED_BEARER = "[REDACTED_BEARER]"

# White space as the event producers understand it, written out
# because neither Java's nor RE2's ``\s`` contains the no-break and Unicode
# spaces.
SPACE = r"\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF"

# Words that introduce a secret in running text.
SECRET_WORDS = (
    "api[_-]?key",
    "api[_-]?secret",
    "secret",
    "password",
    "passwd",
    "pwd",
    "token",
    "auth(?:orization)?",
    "jwt",
)

# A part of each secret word that every spelling of it contains (lower case).
SECRET_STEMS = ("apikey", "api_key", "api-key", "secret", "passw", "pwd", "token", "auth", "jwt")

# Names of fields whose value is always replaced.  The first
# group may stand anywhere in the name, the second only between word borders.
SECRET_NAME_PARTS = (
    "password",
    "passwd",
    "secret",
    "token",
    "apikey",
    "apisecret",
    "set-cookie",
    "session",
    "x-api-key",
    "x-api-secret",
)
SECRET_NAME_WORDS = (
    "pwd",
    "auth(?:orization)?",
    "api[_-]?key",
    "api[_-]?secret",
    "jwt",
    "cookie",
)
MASKED_NAME_PARTS = ("email",)

_B64URL = "[A-Za-z0-9_-]"
_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

JWT = rf"eyJ{_B64URL}+\.{_B64URL}+\.{_B64URL}+"
BEARER = rf"(?i)bearer[{SPACE}]+[A-Z0-9._~+/-]+=*"
# (the look-ahead turns most positions away before the alternatives are tried)
_KV_HEAD = rf"(?i)(?=[apstj])({'|'.join(SECRET_WORDS)})([\"'{SPACE}:=]+)"
_KV_VALUE = rf"[^\"'{SPACE},}}\]]+"
# A whole marker; text that goes on after it is a value like any other.
_MARK = r"\[REDACTED(?:_CARD|_JWT|_BEARER)?\]"
_MARKER = rf"{_MARK}(?![A-Za-z0-9])"
# A value that an earlier pass (or an earlier rule) already replaced is left
# alone; ``strict`` drops that guard.  (The first look-ahead keeps the second
# from scanning a long run of separators again and again.)
KEY_VALUE = rf"{_KV_HEAD}(?=[^\"'{SPACE},}}\]])(?![\"'{SPACE}:=]*{_MARKER})(?:{_MARK})?{_KV_VALUE}"
KEY_VALUE_STRICT = _KV_HEAD + _KV_VALUE
# A match may only start where a run of local-part characters starts (or where
# the previous match ended): the same matches as without the look-behind, in
# linear rather than quadratic time on long runs without an ``@``.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@({_DOMAIN})"
WHOLE_EMAIL = rf"\A{_LOCAL}+@({_DOMAIN})\z"
# ASCII word borders: Java's ``\b`` follows Unicode letters.
CARD = r"(?<![A-Za-z0-9_])[0-9]{13,19}(?![A-Za-z0-9_])"

DB_URL = rf"(?i)postgres(?:ql)?://[^\"'{SPACE}]+"
DB_PASSWORD = rf"(?i)((?:pg)?password)[{SPACE}]*=[{SPACE}]*[^{SPACE}]+"

SECRET_NAME = "(?i)" + "|".join(
    [re.escape(p) for p in SECRET_NAME_PARTS]
    + [r"x-[a-z]+-signature"]
    + [rf"(?<![A-Za-z0-9_])(?:{'|'.join(SECRET_NAME_WORDS)})(?![A-Za-z0-9_])"]
)
MASKED_NAME = "(?i)" + "|".join(MASKED_NAME_PARTS)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut_long(c: Column | str, limit: int = MAX_STRING_CHARS) -> Column:
    """Keep the first ``limit`` characters and say how many were removed."""
    c = _col(c)
    n = F.char_length(c)
    return F.when(
        n > limit,
        F.concat(
            F.substring(c, 1, limit),
            F.lit("... [truncated "),
            (n - limit).cast("string"),
            F.lit(" chars]"),
        ),
    ).otherwise(c)


def _replace_if(c: Column | str, marks: tuple[str, ...], pattern: str, by: str, fold: bool = False) -> Column:
    """Replace ``pattern``, but only run it on texts that hold one of ``marks``.

    A substring test costs a fraction of a regular expression, and most texts
    hold none of the marks.
    """

    def holds_mark(text: Column) -> Column:
        return reduce(or_, [text.contains(m) for m in marks])

    def rule(text: Column) -> Column:
        hit = bind(F.lower(text), holds_mark) if fold else holds_mark(text)
        return F.when(hit, F.regexp_replace(text, pattern, by)).otherwise(text)

    return bind(_col(c), rule)


def redact_jwt(c: Column | str) -> Column:
    """R1b."""
    return _replace_if(c, ("eyJ",), JWT, REDACTED_JWT)


def redact_bearer(c: Column | str) -> Column:
    """R1c."""
    return _replace_if(c, ("bearer",), BEARER, REDACTED_BEARER, fold=True)


def redact_key_values(c: Column | str, strict: bool = False) -> Column:
    """R1d: keep key and separator, replace the value."""
    return _replace_if(c, SECRET_STEMS, KEY_VALUE_STRICT if strict else KEY_VALUE, "$1$2" + REDACTED, fold=True)


def mask_emails(c: Column | str) -> Column:
    """R1e."""
    return _replace_if(c, ("@",), EMAIL, "*@$1")


def redact_cards(c: Column | str) -> Column:
    """R1f: replace digit runs of card length that pass the Luhn check.

    The text between candidates and the candidates themselves are interleaved
    again after the check.  Texts without a candidate skip all of it.
    """

    def rebuild(text: Column) -> Column:
        gaps = F.split(text, CARD, -1)
        runs = F.regexp_extract_all(text, F.lit(CARD), F.lit(0))
        checked = F.transform(
            runs, lambda d: F.when(F.call_function("luhn_check", d), F.lit(REDACTED_CARD)).otherwise(d)
        )
        return F.array_join(
            F.zip_with(gaps, checked, lambda g, d: F.concat(g, F.coalesce(d, F.lit("")))), ""
        )

    return bind(_col(c), lambda t: F.when(t.rlike("[0-9]{13}"), rebuild(t)).otherwise(t))


def scrub_string(c: Column | str, strict: bool = False) -> Column:
    """Length cut, then JWT, bearer, key/value, e-mail and card rules."""
    out = cut_long(c)
    out = redact_bearer(redact_jwt(out))
    return redact_cards(mask_emails(redact_key_values(out, strict)))


def mask_email(c: Column | str, strict: bool = False) -> Column:
    """R2: a value that is one e-mail address keeps its domain; else R1."""
    c = _col(c)
    return F.when(
        c.rlike(WHOLE_EMAIL), F.regexp_replace(c, WHOLE_EMAIL, "*@$1")
    ).otherwise(scrub_string(c, strict))


def is_secret_key(name: Column | str) -> Column:
    """R3 on data (map keys); ``secret_name`` does the same for schema fields."""
    return _col(name).rlike(SECRET_NAME)


def is_mask_key(name: Column | str) -> Column:
    """R4 on data."""
    return _col(name).rlike(MASKED_NAME)


def scrub_db_errors(c: Column | str, limit: int = 1000) -> Column:
    """Hide connection URLs and password assignments in database messages."""
    out = F.regexp_replace(_col(c), DB_URL, "postgresql://***")
    out = F.regexp_replace(out, DB_PASSWORD, "$1=***")
    out = F.regexp_replace(out, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")
    return F.substring(out, 1, limit)


# --- the same rules for one Python string (used inside Arrow batches) --------


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern.replace(r"\G|", "").replace(r"\z", r"\Z"), re.ASCII)


_PY_JWT = _compiled(JWT)
_PY_BEARER = _compiled(BEARER)
_PY_KEY_VALUE = _compiled(KEY_VALUE)
_PY_EMAIL = re.compile(rf"{_LOCAL}+@({_DOMAIN})")
# addresses that touch each other, found from the start of a run only (``re``
# has no ``\G``)
_PY_EMAIL_CHAIN = re.compile(rf"(?<!{_LOCAL})(?:{_LOCAL}++@{_DOMAIN})+")
_PY_WHOLE_EMAIL = _compiled(WHOLE_EMAIL)
_PY_CARD = _compiled(CARD)
_PY_DIGITS = re.compile("[0-9]{13}")
_PY_SECRET_NAME = _compiled(SECRET_NAME)
_PY_MASKED_NAME = _compiled(MASKED_NAME)


def secret_name(name: str) -> bool:
    return _PY_SECRET_NAME.search(name) is not None


def masked_name(name: str) -> bool:
    return _PY_MASKED_NAME.search(name) is not None


def luhn_ok(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def scrub_text(s: str) -> str:
    if len(s) > MAX_STRING_CHARS:
        s = f"{s[:MAX_STRING_CHARS]}... [truncated {len(s) - MAX_STRING_CHARS} chars]"
    # plain substring tests first: they are far cheaper than the patterns
    if "eyJ" in s:
        s = _PY_JWT.sub(REDACTED_JWT, s)
    low = s.lower()
    if "bearer" in low:
        s = _PY_BEARER.sub(REDACTED_BEARER, s)
    if any(w in low for w in SECRET_STEMS):
        s = _PY_KEY_VALUE.sub(lambda m: m[1] + m[2] + REDACTED, s)
    if "@" in s:
        s = _PY_EMAIL_CHAIN.sub(lambda m: _PY_EMAIL.sub(r"*@\1", m[0]), s)
    if _PY_DIGITS.search(s):
        s = _PY_CARD.sub(lambda m: REDACTED_CARD if luhn_ok(m[0]) else m[0], s)
    return s


def mask_text(s: str) -> str:
    m = _PY_WHOLE_EMAIL.match(s)
    return "*@" + m[1] if m else scrub_text(s)
