"""Matching requests against IP and CIDR blocklists.

An entry list is turned into *cover* rows: one row per (prefix length, network)
and span of time in which a given entry is the first active one; exact entries
are rows keyed by their text.  The spans of one network never overlap, so a
request finds at most one row per prefix length and no join fans out.

Small lists: one broadcast hash join per prefix length that occurs in the list
(at most 34), no shuffle of the requests at all.  Large lists: all entries are
folded into one table of disjoint ranges of addresses, each with the entries
that hold there, and requests are merged with it in order of their addresses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalloom.functions.delay import next_poll
from signalloom.functions.net import ipv4_to_long, network_of, normalize_ip
from signalloom.functions.redact import bind
from signalloom.limits import POLL_MS
from signalloom.operators.ordered import HOT_ROWS, LastKnown, SinceReset, as_of, running
from signalloom.operators.sizing import MAX_BROADCAST_ROWS, maybe_broadcast, values_if_small
from signalloom.sources.scratch import materialize

EXACT = -1  # "prefix length" of entries that match as text
BEGIN = "1000-01-01 00:00:00"
END = "9999-12-31 00:00:00"
LAST = "9999-12-30 23:59:59"


def _bound(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _mask(prefix: Column) -> Column:
    ones = F.lit(0xFFFFFFFF).cast("long")
    return F.call_function("shiftleft", ones, 32 - prefix).bitwiseAND(ones)


def exact_match(ip: Column | str, entry_value: Column | str) -> Column:
    """F4 predicate: equality after normalisation of both sides."""
    return normalize_ip(ip) == normalize_ip(entry_value)


def cidr_parts(value: Column | str) -> Column:
    """``struct<prefix, network>`` of an IPv4 range, null if it is none.

    The length is one or two decimal digits from 0 to 32.  What follows a
    second slash is ignored.
    """
    value = F.col(value) if isinstance(value, str) else value

    def numbers(part: Column) -> Column:
        return F.struct(part[1].cast("int").alias("prefix"), ipv4_to_long(part[0]).alias("network"))

    def masked(n: Column) -> Column:
        network = n["network"].bitwiseAND(_mask(n["prefix"]))
        usable = (n["prefix"] <= 32) & network.isNotNull()
        return F.when(usable, F.struct(n["prefix"].alias("prefix"), network.alias("network")))

    shaped = value.rlike(r"\A[0-9.]+/[0-9]{1,2}(?:/|\z)")
    return F.when(shaped, bind(bind(F.split(value, "/"), numbers), masked))


def ip_in_cidr(ip: Column | str, cidr: Column | str) -> Column:
    """F5 predicate for one pair; joins use ``cover`` instead."""
    parts = cidr_parts(cidr)
    return F.coalesce(ipv4_to_long(ip).bitwiseAND(_mask(parts["prefix"])) == parts["network"], F.lit(False))


def entry_active(expires_at: Column | str, now: Column | str) -> Column:
    """no expiry, or an expiry strictly after ``now``."""
    e = F.col(expires_at) if isinstance(expires_at, str) else expires_at
    n = F.col(now) if isinstance(now, str) else now
    return e.isNull() | (e > n)


def parse_expiry(text: Column | str) -> Column:
    """Expiry from text; missing, empty or unreadable means permanent (null)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def cover(entries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cover rows of ``entries(pos, type, value, expires_at [, *by])``.

    Columns: ``*by, prefix, network, text, pos, value, span_from, span_to``.
    Entries that can never match (ASN, IPv6 ranges, malformed ranges) drop out.
    """
    is_ip, is_cidr = F.col("type") == "IP", F.col("type") == "CIDR"
    keyed = (
        entries.filter(is_ip | is_cidr)
        .withColumn("__cidr", F.when(is_cidr, cidr_parts("value")))
        .filter(is_ip | F.col("__cidr").isNotNull())
        .select(
            *by,
            F.when(is_cidr, F.col("__cidr.prefix")).otherwise(F.lit(EXACT)).alias("prefix"),
            F.when(is_cidr, F.col("__cidr.network")).otherwise(F.lit(0).cast("long")).alias("network"),
            F.when(is_ip, normalize_ip("value")).otherwise(F.lit("")).alias("text"),
            F.col("pos"),
            F.col("value"),
            F.coalesce(F.col("expires_at").cast("timestamp_ntz"), _bound(END)).alias("__to"),
        )
        .filter((F.col("text") != "") | (F.col("prefix") != EXACT))
    )
    return _first_active_spans(keyed, [*by, "prefix", "network", "text"])


def _first_active_spans(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Disjoint spans in which the entry with the lowest ``pos`` is the active one.

    An entry is the first active one exactly from the time all entries before
    it have expired.  Of the entries that expire at the same time only the
    first can count; dropping the others beforehand is an ordinary aggregation
    and keeps the window small when a list repeats a value many times.
    """
    firsts = rows.groupBy(*key, "__to").agg(F.min_by(F.struct("pos", "value"), "pos").alias("__e"))
    earlier = (
        Window.partitionBy(*key)
        .orderBy(F.col("__e.pos"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        firsts.withColumn("span_from", F.coalesce(F.max("__to").over(earlier), _bound(BEGIN)))
        .filter(F.col("span_from") < F.col("__to"))
        .select(
            *key,
            F.col("__e.pos").alias("pos"),
            F.col("__e.value").alias("value"),
            "span_from",
            F.col("__to").alias("span_to"),
        )
    )


def match_blocklist(
    requests: DataFrame,
    entries: DataFrame,
    ip: str = "ip",
    ts: str | Column = "ts",
    by: Sequence[str] = (),
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """adds ``matched_pos`` and ``matched_value`` of the first active entry.

    ``ip`` is used as given (apply F1 and F2 before); blank and ``unknown``
    match nothing.  ``ts`` is the time at which entries must be active: a
    column, or a literal for one "now"; at no time at all only entries that
    never expire are.  ``by`` names columns that must be equal on both sides (a
    tenant, a list version).
    """
    at = (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
    at = F.coalesce(at, F.lit(LAST).cast("timestamp_ntz"))
    lengths = values_if_small(entries, _prefix_of_entry(), max_broadcast_rows)
    if lengths is not None:
        # a list of proven size is prepared in one task, without a shuffle, and read back for each length
        covered = materialize(cover(entries.coalesce(1), by), "cover")
        return _match_small(requests, covered, sorted(lengths - {None}), ip, at, list(by))
    ranges = materialize(address_ranges(materialize(cover(entries, by), "cover"), by), "ranges")
    return _match_ranges(requests, ranges, ip, at, list(by), hot_rows)


def _prefix_of_entry() -> Column:
    return F.when(F.col("type") == "IP", F.lit(EXACT)).when(F.col("type") == "CIDR", cidr_parts("value")["prefix"])


def _match_small(
    requests: DataFrame, covered: DataFrame, lengths: list[int], ip: str, at: Column, by: list[str]
) -> DataFrame:
    out = requests.select("*", at.alias("__at"), ipv4_to_long(ip).alias("__addr"))
    for n in lengths:
        side = F.broadcast(
            covered.filter(F.col("prefix") == n).select(
                *[F.col(b).alias(f"__b_{b}") for b in by],
                (F.col("text") if n == EXACT else F.col("network")).alias("__key"),
                F.col("span_from").alias("__f"),
                F.col("span_to").alias("__t"),
                F.struct("pos", "value").alias(f"__hit_{n + 1}"),
            )
        )
        # (blank and "unknown" are not matched even if a list contains them)
        probe = (
            F.when(~F.col(ip).isin("", "unknown"), F.col(ip)) if n == EXACT else network_of(F.col("__addr"), n)
        )
        cond = (probe == F.col("__key")) & (F.col("__at") >= F.col("__f")) & (F.col("__at") < F.col("__t"))
        for b in by:
            cond = cond & (F.col(b) == F.col(f"__b_{b}"))
        out = out.join(side, cond, "left").drop("__key", "__f", "__t", *[f"__b_{b}" for b in by])
    hits = [F.col(f"__hit_{n + 1}") for n in lengths]
    # structs compare by pos first, and least() skips nulls
    best = hits[0] if len(hits) == 1 else F.least(*hits) if hits else None
    if best is None:
        pos_type, value_type = covered.schema["pos"].dataType, covered.schema["value"].dataType
        return out.drop("__at", "__addr").select(
            "*", F.lit(None).cast(pos_type).alias("matched_pos"), F.lit(None).cast(value_type).alias("matched_value")
        )
    return (
        out.withColumn("__best", best)
        .select("*", F.col("__best.pos").alias("matched_pos"), F.col("__best.value").alias("matched_value"))
        .drop("__at", "__addr", "__best", *[f"__hit_{n + 1}" for n in lengths])
    )


_LOW, _END_OF_IPV4, _TEXT = "a", "b", "t"


def _address_key(address: Column, text: Column) -> Column:
    """Text whose order is that of addresses, then of how they are written; texts that are no IPv4 address come after."""
    number = F.concat(F.lit(_LOW), F.lpad(F.lower(F.hex(address)), 8, "0"), text)
    return F.when(address.isNotNull(), number).otherwise(F.concat(F.lit(_TEXT), text))


def address_ranges(covered: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The list as disjoint ranges in order of addresses: ``*by, range_from, entries``.

    A range ends where the next one of the same ``by`` begins.  ``entries`` are
    those that hold in it, with the time in which each is the first of its
    network: ``struct<pos, value, span_from, span_to>``.  Where a network or an
    exact entry begins or ends a range begins; which networks hold there is
    looked up by the prefix lengths in use, so that no two entries are compared.
    """
    address = F.when(F.col("prefix") == EXACT, ipv4_to_long("text")).otherwise(F.col("network"))
    above = F.col("network") + F.call_function("shiftleft", F.lit(1).cast("long"), 32 - F.col("prefix"))
    begin = F.when(F.col("prefix") == EXACT, _address_key(address, F.col("text"))).otherwise(_address_key(address, F.lit("")))
    end = (
        F.when(F.col("prefix") == EXACT, F.concat(begin, F.lit("\0")))
        .when(above > 0xFFFFFFFF, F.lit(_END_OF_IPV4))
        .otherwise(_address_key(above, F.lit("")))
    )
    points = F.array(
        F.struct(begin.alias("range_from"), address.alias("address"), F.col("text").alias("text")),
        # after an exact entry the networks around it go on; after a network the next address begins
        F.struct(
            end.alias("range_from"),
            F.when(F.col("prefix") == EXACT, address).when(above <= 0xFFFFFFFF, above).alias("address"),
            F.lit(None).cast("string").alias("text"),
        ),
    )
    edges = covered.select(*by, F.explode(points).alias("__p")).select(*by, "__p.*")
    edges = edges.groupBy(*by, "range_from").agg(F.max("address").alias("address"), F.max("text").alias("text"))
    lengths = [r["prefix"] for r in covered.select("prefix").distinct().limit(34).collect()]  # at most 34 values
    probes = F.array(
        *[
            F.struct(
                F.lit(n).alias("prefix"),
                (F.lit(0).cast("long") if n == EXACT else network_of(F.col("address"), n)).alias("network"),
                (F.col("text") if n == EXACT else F.lit("")).alias("text"),
            )
            for n in sorted(lengths)
        ]
    )
    edges = materialize(edges, "edges")
    asked = edges.select(*by, "range_from", F.explode(probes).alias("__q")).select(*by, "range_from", "__q.*")
    key = [*by, "prefix", "network", "text"]
    # networks of short prefixes hold in very many ranges, but there are few of them
    short = F.col("prefix").between(0, 8)
    few, many = covered.where(short), covered.where(~short)
    found = asked.where(short).join(maybe_broadcast(few), key).unionByName(asked.where(~short).join(many, key))
    entry = F.struct("pos", "value", "span_from", "span_to")
    held = found.groupBy(*by, "range_from").agg(F.collect_list(entry).alias("entries"))
    return edges.select(*by, "range_from").join(held, [*by, "range_from"], "left")


def _match_ranges(requests: DataFrame, ranges: DataFrame, ip: str, at: Column, by: list[str], hot_rows: int | None) -> DataFrame:
    text = F.when(~F.col(ip).isin("", "unknown"), F.col(ip))
    placed = requests.withColumns({"__when": at, "__key": _address_key(ipv4_to_long(text), text)})
    if "void" not in placed.schema.simpleString():
        # as_of reads them several times: to count, to sample and to merge
        placed = materialize(placed, "placed")
    found = as_of(placed, ranges, by, ("__key", "range_from"), ["entries"], hot_rows)
    active = F.filter("entries", lambda e: (e["span_from"] <= F.col("__when")) & (F.col("__when") < e["span_to"]))
    # structs compare by pos first
    best = found.withColumn("__best", F.array_min(F.transform(active, lambda e: F.struct(e["pos"], e["value"]))))
    return best.select(*requests.columns, F.col("__best.pos").alias("matched_pos"), F.col("__best.value").alias("matched_value"))


def firewall_verdict(df: DataFrame, mode: str | Column = "mode", unknown_enforces: bool = False) -> DataFrame:
    """F8: adds ``action`` (pass / block), ``status`` (403 when blocked) and ``report_type``.

    ``df`` carries ``matched_value`` and a mode (a column, or ``F.lit``; null
    means no list was ever loaded).  Unknown modes pass; the strict behaviour,
    in which any other mode enforces, is ``unknown_enforces=True``.
    """
    m = F.col(mode) if isinstance(mode, str) else mode
    hit = F.col("matched_value").isNotNull()
    enforce = m.isNotNull() & ~m.isin("OFF", "MONITOR") if unknown_enforces else m == "ENFORCE"
    blocked = F.coalesce(hit & enforce, F.lit(False))
    return df.select(
        "*",
        F.when(blocked, "block").otherwise("pass").alias("action"),
        F.when(blocked, F.lit(403)).alias("status"),
        F.when(blocked, "FIREWALL_BLOCK")
        .when(hit & (m == "MONITOR"), "FIREWALL_WOULD_BLOCK")
        .alias("report_type"),
    )


def firewall_events(verdicts: DataFrame, method: str | None = None, path: Sequence[str] = ()) -> DataFrame:
    """one security event per reported request.

    ``path`` names the columns to try in order (original URL, then URL).
    Other columns of the request are kept for joining the event back.
    """
    meta = [F.col("matched_value").alias("matchedValue")]
    if method:
        meta.append(F.col(method).alias("method"))
    if path:
        meta.append(F.coalesce(*[F.col(p) for p in path]).alias("path"))
    verb = F.when(F.col("report_type") == "FIREWALL_BLOCK", F.lit("Firewall: blocked ")).otherwise(
        F.lit("Firewall (monitor): would block ")
    )
    return verdicts.filter(F.col("report_type").isNotNull()).select(
        "*",
        F.lit("security").alias("event_kind"),
        F.concat(verb, F.col("ip"), F.lit(" (rule "), F.col("matched_value"), F.lit(")")).alias("description"),
        F.to_json(F.struct(*meta)).alias("metadata_json"),
    )


def blocked(verdicts: DataFrame) -> DataFrame:
    """requests answered with 403."""
    return verdicts.filter(F.col("action") == "block")


def allowed(verdicts: DataFrame) -> DataFrame:
    """requests that go on."""
    return verdicts.filter(F.col("action") == "pass")


def match_point_in_time(
    requests: DataFrame,
    snapshots: DataFrame,
    ip: str = "ip",
    ts: str = "ts",
    by: Sequence[str] = (),
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """each request against the list last fetched before it.

    ``snapshots`` holds one row per fetch: ``fetched_at, mode, entries`` with
    ``entries`` an array of ``struct<type, value, expires_at>`` in list order
    (and the columns ``by``); of several with one time any is taken.  Adds
    ``valid_from``, ``mode`` and the match.  Lists are written once; requests are
    merged with the times of the fetches (``as_of``), then with the list in force.
    """
    by = list(by)
    fetched = snapshots.withColumn("valid_from", F.col("fetched_at").cast("timestamp_ntz")).dropDuplicates([*by, "valid_from"])
    lists = materialize(fetched.select(*by, "valid_from", "mode", "entries"), "lists")
    timed = requests.withColumn("__ts", F.col(ts).cast("timestamp_ntz"))
    versioned = as_of(timed, lists, by, ("__ts", "valid_from"), ["valid_from", "mode"], hot_rows).drop("__ts")
    listed = lists.select(*by, "valid_from", F.posexplode("entries").alias("pos", "__e"))
    listed = listed.select(*by, "valid_from", "pos", "__e.type", "__e.value", "__e.expires_at")
    return match_blocklist(versioned, listed, ip, ts, [*by, "valid_from"], max_broadcast_rows, hot_rows)


def fold_polls(
    polls: DataFrame,
    by: str = "client",
    order: Sequence[str] = ("ts", "poll_id"),
    base_ms: int = POLL_MS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """state of a poller after each poll.

    Input ``client, poll_id, ts, status, mode, etag`` with a null status for
    a poll that threw.  Adds ``state_mode, state_etag, fetched_at`` (of the
    last 200), ``errors_in_row`` (since the last 200 or 304) and
    ``next_poll_ms``.
    """
    ok = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    good = ok | F.coalesce(F.col("status") == 304, F.lit(False))
    state = F.when(ok, F.struct(F.col("mode"), F.col("etag"), F.col(order[0]).alias("at")))
    folded = running(polls, by, order, {"__state": LastKnown(state), "__errors": SinceReset(good)}, hot_rows)
    return (
        folded.select(
            *polls.columns,
            F.col("__state.mode").alias("state_mode"),
            F.col("__state.etag").alias("state_etag"),
            F.col("__state.at").alias("fetched_at"),
            F.col("__errors").cast("int").alias("errors_in_row"),
        )
        .withColumn("next_poll_ms", next_poll("errors_in_row", base_ms))
    )
