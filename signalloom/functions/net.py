"""Client addresses, IPv4 arithmetic, user agents, database URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalloom.functions.redact import SPACE, bind
from signalloom.functions.text import filled

_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
IPV4 = rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def client_ip(
    forwarded: Column | str,
    real_ip: Column | str,
    request_ip: Column | str | None = None,
    socket_addr: Column | str | None = None,
) -> Column:
    """first hop of X-Forwarded-For, else X-Real-IP, else request, else socket.

    A forwarded header that starts with a comma gives the empty string and
    does not fall through.
    """
    forwarded, real_ip = _col(forwarded), _col(real_ip)
    rest = F.lit("unknown")
    for c in (socket_addr, request_ip):
        if c is not None:
            rest = filled(c, rest)
    return (
        F.when(F.char_length(forwarded) > 0, trim_space(F.substring_index(forwarded, ",", 1)))
        .when(F.char_length(real_ip) > 0, real_ip)
        .otherwise(rest)
    )


def normalize_ip(c: Column | str) -> Column:
    """trimmed, lower case, without the prefix of an IPv4-mapped address."""
    s = F.lower(trim_space(F.coalesce(_col(c), F.lit(""))))
    return F.regexp_replace(s, r"\A::ffff:([0-9]{1,3}(?:\.[0-9]{1,3}){3})\z", "$1")


def ipv4_to_long(c: Column | str) -> Column:
    """the address as a number, null unless four parts of 0 to 255."""
    c = _col(c)

    def number(part: Column) -> Column:
        return sum((part[i].cast("long") * (1 << 8 * (3 - i)) for i in range(1, 4)), part[0].cast("long") * (1 << 24))

    # the pattern also guards the casts, which fail on other text under ANSI
    return F.when(c.rlike(IPV4), bind(F.split(c, r"\."), number))


def network_of(address: Column, prefix: int) -> Column:
    """The address with everything after ``prefix`` bits cleared."""
    keep = (0xFFFFFFFF << (32 - prefix)) & 0xFFFFFFFF
    return address.bitwiseAND(F.lit(keep).cast("long"))


def os_family(user_agent: Column | str, strict_order: bool = True) -> Column:
    """Operating system named in a user agent.

    The strict order finds desktop names first, so Android agents (which say
    Linux) come out as Linux and iPhone agents (which say Mac OS) as macOS.
    ``strict_order=False`` looks for the mobile names first.
    """
    ua = _col(user_agent)
    desktop = [("Windows", ["Windows"]), ("macOS", ["Mac OS"]), ("Linux", ["Linux"])]
    mobile = [("Android", ["Android"]), ("iOS", ["iOS", "iPhone", "iPad"])]
    out = None
    for name, marks in desktop + mobile if strict_order else mobile + desktop:
        hit = ua.contains(marks[0])
        for m in marks[1:]:
            hit = hit | ua.contains(m)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Unknown")


def connection_properties(url: Column | str) -> Column:
    """A database URL as a struct of decoded parts (null where absent)."""
    url = _col(url)

    def part(name: str, key: str | None = None) -> Column:
        args = [url, F.lit(name)] + ([F.lit(key)] if key else [])
        return F.when(url.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), F.try_parse_url(*args))

    def decoded(c: Column) -> Column:
        # percent-decoding only: a plus sign is not a space here
        return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    userinfo = part("USERINFO")
    port = F.regexp_extract(part("AUTHORITY"), r":([0-9]+)\z", 1)
    database = F.regexp_replace(part("PATH"), r"\A/", "")
    return F.struct(
        decoded(part("HOST")).alias("host"),
        F.when(port != "", port.cast("int")).alias("port"),
        decoded(F.nullif(F.substring_index(userinfo, ":", 1), F.lit(""))).alias("user"),
        decoded(
            F.when(userinfo.contains(":"), F.nullif(F.regexp_replace(userinfo, r"\A[^:]*:", ""), F.lit("")))
        ).alias("password"),
        decoded(F.nullif(database, F.lit(""))).alias("database"),
        decoded(F.nullif(part("QUERY", "sslmode"), F.lit(""))).alias("sslmode"),
    )
