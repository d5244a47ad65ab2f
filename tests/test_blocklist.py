import datetime as dt
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from signalloom.functions.net import client_ip, ipv4_to_long, normalize_ip
from signalloom.operators import blocklist as B
from signalloom.operators.ordered import as_of

ENTRY = "pos int, type string, value string, expires_at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def _match(spark, ips, entries, now=T0, **kw):
    reqs = spark.createDataFrame([(i, ip, now) for i, ip in enumerate(ips)], "id int, ip string, ts timestamp_ntz")
    rows = B.match_blocklist(reqs, spark.createDataFrame(entries, ENTRY), **kw).orderBy("id").collect()
    return [r["matched_pos"] for r in rows]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_vectors(spark, limit):
    entries = [
        (1, "ASN", "AS1", None),
        (2, "IP", "1.2.3.4", None),
        (3, "CIDR", "45.198.224.0/24", None),
        (4, "IP", "::FFFF:9.9.9.9", None),
        (5, "IP", "2001:db8::1", None),
        (6, "CIDR", "10.0.0.0/", None),
        (7, "CIDR", "10.0.0.0/33", None),
        (8, "CIDR", "10.0.0.0/0x8", None),
        (9, "CIDR", "2001:db8::/32", None),
        (10, "IP", "999.1.1.1", None),
        (11, "IP", "unknown", None),
        (12, "IP", "", None),
        (13, "CIDR", "11.0.0.300/8", None),
        (14, "CIDR", "12.0.0.0/8/junk", None),
        (15, "IP", "5.5.5.5", T0),
        (16, "IP", "6.6.6.6", T0 + dt.timedelta(seconds=1)),
    ]
    ips = ["1.2.3.4", "45.198.224.244", "45.198.225.1", "9.9.9.9", "2001:db8::1", "10.0.0.1", "2001:db8::2",
           "999.1.1.1", "unknown", "", "11.1.1.1", "12.3.4.5", "5.5.5.5", "6.6.6.6"]
    want = [2, 3, None, 4, 5, None, None, 10, None, None, None, 14, None, 16]
    assert _match(spark, ips, entries, max_broadcast_rows=limit) == want


@pytest.mark.parametrize("limit", [100_000, 0])
def test_zero_prefix_matches_ipv4_only(spark, limit):
    entries = [(1, "CIDR", "0.0.0.0/0", None)]
    assert _match(spark, ["1.2.3.4", "::1", "1.2.3.256", "01.002.3.4"], entries, max_broadcast_rows=limit) == [1, None, None, 1]


def test_empty_list(spark):
    assert _match(spark, ["1.2.3.4"], [(1, "ASN", "x", None)]) == [None]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_random_lists_against_the_definition(spark, limit):
    rnd = random.Random(3)
    entries = []
    for pos in range(1, 61):
        base = f"10.{rnd.randint(0, 1)}.{rnd.randint(0, 3)}.{rnd.randint(0, 255)}"
        exp = rnd.choice([None, *[T0 + dt.timedelta(hours=h) for h in range(6)]])
        kind = rnd.choice(["IP", "CIDR", "CIDR"])
        entries.append((pos, kind, base if kind == "IP" else f"{base}/{rnd.choice([0, 8, 15, 22, 24, 25, 30, 32])}", exp))
    entries = [e for e in entries if not e[2].endswith("/0") or e[3] is not None]
    rnd.shuffle(entries)
    entries.sort(key=lambda e: e[0])
    reqs = []
    for i in range(600):
        # a third of all requests come from one address
        ip = "10.0.1.7" if i % 3 == 0 else f"10.{rnd.randint(0, 2)}.{rnd.randint(0, 3)}.{rnd.randint(0, 255)}"
        reqs.append((i, ip, T0 + dt.timedelta(minutes=rnd.randint(-30, 360))))

    def first(ip, ts):
        for pos, kind, value, exp in entries:
            if exp is not None and exp <= ts:
                continue
            if kind == "IP" and value == ip:
                return pos
            if kind == "CIDR" and ipaddress.ip_address(ip) in ipaddress.ip_network(value, strict=False):
                return pos
        return None

    df = spark.createDataFrame(reqs, "id int, ip string, ts timestamp_ntz")
    got = B.match_blocklist(df, spark.createDataFrame(entries, ENTRY), max_broadcast_rows=limit)
    got = {r["id"]: r["matched_pos"] for r in got.collect()}
    assert got == {i: first(ip, ts) for i, ip, ts in reqs}


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_ranges_with_wide_networks_and_hot_addresses(spark, hot_rows):
    entries = [(1, "CIDR", "10.0.0.0/8", T0), (2, "IP", "1.2.3.4", T0), (3, "IP", "10.0.0.7", None), (4, "CIDR", "0.0.0.0/0", T0 + dt.timedelta(days=1)),
               (5, "CIDR", "255.255.255.0/24", None), (6, "IP", "zz", None), (7, "CIDR", "10.0.0.4/30", None), (8, "IP", "10.0.0.08", None)]
    ips = ["10.9.9.9"] * 50 + ["1.2.3.4", "10.0.0.7", "10.0.0.07", "10.0.0.08", "10.0.0.5", "255.255.255.255", "zz", "zz2", "z", "8.8.8.8", "0.0.0.0"]
    want = [4] * 50 + [4, 3, 4, 4, 4, 4, 6, None, None, 4, 4]
    assert _match(spark, ips, entries, max_broadcast_rows=0, hot_rows=hot_rows) == want
    late = [(p, k, v, None if p == 2 else (T0 if e and e > T0 else e)) for p, k, v, e in entries]
    want = [None] * 50 + [2, 3, 7, 8, 7, 5, 6, None, None, None, None]
    assert _match(spark, ips, late, max_broadcast_rows=0, hot_rows=hot_rows) == want
    assert _match(spark, ips, late) == want


def test_large_lists_are_merged_by_one_window(spark):
    entries = spark.createDataFrame([(1, "CIDR", "10.0.0.0/8", None), (2, "IP", "1.1.1.1", None)], ENTRY)
    reqs = spark.createDataFrame([("10.1.1.1", T0)], "ip string, ts timestamp_ntz")
    plan = B.match_blocklist(reqs, entries, max_broadcast_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 1


@pytest.mark.parametrize("hot_rows", [0, 40, 10**6])
def test_as_of_against_a_loop(spark, hot_rows):
    """Most rows at a few moments of one key; nulls on both sides."""
    rnd = random.Random(8)
    at = lambda: T0 + dt.timedelta(minutes=rnd.choice([0, 1, 1, 1, 2, 7]))
    left = [(i, rnd.choice(["a", "a", "a", "b", None]), at() if i % 17 else None) for i in range(300)]
    right = [(rnd.choice(["a", "b", None]), T0 + dt.timedelta(seconds=20 * i), i) for i in range(12)] + [("a", None, 99)]
    got = as_of(
        spark.createDataFrame(left, "id int, k string, t timestamp_ntz"), spark.createDataFrame(right, "k string, f timestamp_ntz, v int"), "k", ("t", "f"), ["v"], hot_rows
    )
    found = {r["id"]: r["v"] for r in got.collect()}
    for i, k, t in left:
        fits = [v for rk, f, v in right if k is not None and rk == k and t is not None and f is not None and f <= t]
        assert found[i] == (max(fits) if fits else None)


def test_no_shuffle_and_no_nested_loop_for_small_lists(spark):
    reqs = spark.range(1000).select(F.concat(F.lit("10.0.0."), F.col("id").cast("string")).alias("ip"), F.lit(T0).cast("timestamp_ntz").alias("ts"))
    out = B.match_blocklist(reqs, spark.createDataFrame([(1, "CIDR", "10.0.0.0/8", None), (2, "IP", "1.1.1.1", None)], ENTRY))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_client_ip(spark):
    cases = [
        (" 1.1.1.1 , 2.2.2.2", "3.3.3.3", "4.4.4.4", "5.5.5.5", "1.1.1.1"),
        (",2.2.2.2", "3.3.3.3", None, None, ""),
        ("", "3.3.3.3", "4.4.4.4", None, "3.3.3.3"),
        (None, "", "4.4.4.4", "5.5.5.5", "4.4.4.4"),
        (None, None, "", "5.5.5.5", "5.5.5.5"),
        (None, None, None, None, "unknown"),
    ]
    df = spark.createDataFrame(cases, "x string, r string, q string, s string, want string")
    assert df.filter(~client_ip("x", "r", "q", "s").eqNullSafe(F.col("want"))).collect() == []


def test_normalize_and_number(spark):
    cases = [("::ffff:1.2.3.4", "1.2.3.4", 16909060), (" 1.2.3.4 ", "1.2.3.4", 16909060), ("::FFFF:abc", "::ffff:abc", None),
             (None, "", None), ("1.2.3.256", "1.2.3.256", None), ("1.2.3", "1.2.3", None), ("255.255.255.255", "255.255.255.255", 2**32 - 1)]
    df = spark.createDataFrame(cases, "s string, norm string, n long")
    out = df.select("*", normalize_ip("s").alias("a")).withColumn("b", ipv4_to_long("a"))
    assert out.filter("not (a <=> norm) or not (b <=> n)").collect() == []


def test_ip_in_cidr(spark):
    df = spark.createDataFrame([("45.198.224.1", "45.198.224.0/24", True), ("45.198.225.1", "45.198.224.0/24", False), ("x", "0.0.0.0/0", False), ("1.1.1.1", "0.0.0.0/0", True)], "ip string, c string, want boolean")
    assert df.filter(B.ip_in_cidr("ip", "c") != F.col("want")).collect() == []


def test_verdicts(spark):
    cases = [(None, "1.1.1.1", "pass", None), ("OFF", "1.1.1.1", "pass", None), ("ENFORCE", None, "pass", None),
             ("MONITOR", "1.1.1.1", "pass", "FIREWALL_WOULD_BLOCK"), ("ENFORCE", "1.1.1.1", "block", "FIREWALL_BLOCK"),
             ("other", "1.1.1.1", "pass", None)]
    df = spark.createDataFrame(cases, "mode string, matched_value string, want string, report string")
    out = B.firewall_verdict(df)
    assert out.filter("action <> want or not (report <=> report_type)").collect() == []
    strict = B.firewall_verdict(df.filter("mode = 'other'"), unknown_enforces=True).first()
    assert (strict["action"], strict["status"], strict["report_type"]) == ("block", 403, "FIREWALL_BLOCK")


def test_events_carry_method_and_path(spark):
    df = spark.createDataFrame([("1.1.1.1", "1.0.0.0/8", "block", "FIREWALL_BLOCK", "GET", None, "/u")], "ip string, matched_value string, action string, report_type string, method string, original_url string, url string")
    row = B.firewall_events(df, "method", ("original_url", "url")).first()
    assert row["description"] == "Firewall: blocked 1.1.1.1 (rule 1.0.0.0/8)"
    assert row["metadata_json"] == '{"matchedValue":"1.0.0.0/8","method":"GET","path":"/u"}'


@pytest.mark.parametrize("limit", [100_000, 0])
def test_point_in_time_per_tenant(spark, limit):
    snap = "tenant string, fetched_at timestamp_ntz, mode string, entries array<struct<type:string,value:string,expires_at:timestamp_ntz>>"
    h = lambda n: T0 + dt.timedelta(hours=n)
    snaps = spark.createDataFrame(
        [
            ("a", h(1), "ENFORCE", [("IP", "1.1.1.1", None)]),
            ("a", h(5), "MONITOR", [("CIDR", "2.0.0.0/8", h(7))]),
            ("b", h(2), "ENFORCE", []),
        ],
        snap,
    )
    reqs = [(0, "a", "1.1.1.1", h(0), None, None), (1, "a", "1.1.1.1", h(1), "ENFORCE", 0), (2, "a", "1.1.1.1", h(4), "ENFORCE", 0),
            (3, "a", "1.1.1.1", h(5), "MONITOR", None), (4, "a", "2.3.4.5", h(6), "MONITOR", 0), (5, "a", "2.3.4.5", h(7), "MONITOR", None),
            (6, "b", "1.1.1.1", h(3), "ENFORCE", None), (7, "c", "1.1.1.1", h(3), None, None)]
    df = spark.createDataFrame(reqs, "id int, tenant string, ip string, ts timestamp_ntz, want_mode string, want_pos int")
    out = B.match_point_in_time(df, snaps, by=["tenant"], max_broadcast_rows=limit)
    assert out.count() == len(reqs)
    assert out.filter("not (mode <=> want_mode) or not (matched_pos <=> want_pos)").collect() == []


@pytest.mark.parametrize("hot_rows", [0, 10**6])
def test_polls(spark, hot_rows):
    h = lambda n: T0 + dt.timedelta(days=n)
    polls = [(1, "c", h(0), 500, None, None), (2, "c", h(1), 200, "ENFORCE", "e1"), (3, "c", h(2), None, None, None), (4, "c", h(3), 503, None, None),
             (5, "c", h(4), 304, None, None), (6, "c", h(5), 429, None, None), (7, "c", h(6), 200, "OFF", "e2")]
    df = spark.createDataFrame(polls, "poll_id int, client string, ts timestamp_ntz, status int, mode string, etag string")
    rows = B.fold_polls(df, hot_rows=hot_rows).orderBy("poll_id").collect()
    assert [r["errors_in_row"] for r in rows] == [1, 0, 1, 2, 0, 1, 0]
    assert [r["state_mode"] for r in rows] == [None, *["ENFORCE"] * 5, "OFF"]
    assert [r["next_poll_ms"] for r in rows] == [90000.0, 45000.0, 90000.0, 180000.0, 45000.0, 90000.0, 45000.0]


def test_requests_are_computed_once_for_a_long_list(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(ip):
        seen.add(1)
        return ip

    entries = spark.createDataFrame([(1, "CIDR", "10.0.0.0/28", None)], "pos int, type string, value string, expires_at timestamp_ntz")
    address = F.concat(F.lit("10.0.0."), (F.col("id") % 200).cast("string"))
    asked = spark.range(2000).select("id", told(address).alias("ip"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"))
    found = B.match_blocklist(asked, entries, max_broadcast_rows=0, hot_rows=100)
    assert sum(r["matched_pos"] is not None for r in found.collect()) == 160
    assert seen.value == 2000
