import datetime as dt
import hashlib
import hmac
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalloom.functions.hashing import hmac_sha256_hex, jitter_minutes, key_fingerprint
from signalloom.operators import delivery as Q
from signalloom.operators import ordered as O
from signalloom.operators import signing as H
from signalloom.operators.timers import pair_timers, timer_events

T0 = dt.datetime(2024, 1, 1)
QUEUE = "event_id long, key string, ts timestamp_ntz, retries int"


def _queue(spark, n=300, keys=("a", "a", "b", None)):
    rnd = random.Random(5)
    rows = [(i, keys[i % len(keys)], T0 + dt.timedelta(minutes=rnd.randint(0, 600)), i % 5) for i in range(n)]
    return spark.createDataFrame(rows, QUEUE), rows


def _by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


def test_fifo_ends(spark):
    df, rows = _queue(spark)
    newest = {r["event_id"] for r in Q.keep_latest(df, 7, "key").collect()}
    oldest = {r["event_id"] for r in Q.take_front(df, 7, "key").collect()}
    groups = _by_key(rows).values()
    assert newest == {r[0] for g in groups for r in g[-7:]}
    assert oldest == {r[0] for g in groups for r in g[:7]}
    assert Q.keep_latest(df, 3).count() == 3


def test_fifo_over_the_window_group_limit(spark):
    df = spark.range(9000).select(F.col("id").alias("event_id"), F.lit("a").alias("key"), F.lit(T0).cast("timestamp_ntz").alias("ts"))
    got = [r["event_id"] for r in Q.keep_latest(df, 2500, "key").collect()]
    assert sorted(got) == list(range(6500, 9000))


def test_limit_is_cut_before_the_shuffle(spark):
    df, _ = _queue(spark)
    plan = Q.keep_latest(df, 100, "key")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_requeue(spark):
    rows = [(i, "a", T0 + dt.timedelta(minutes=i), 0) for i in range(10)]
    df = spark.createDataFrame(rows, QUEUE)
    out = Q.requeue_front(df.filter("event_id >= 4"), df.filter("event_id < 4"), 6, now=F.lit(T0)).orderBy("prio", "event_id").collect()
    assert [(r["event_id"], r["retries"]) for r in out] == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 0), (5, 0)]
    assert out[0]["last_attempt"] == T0 and out[5]["last_attempt"] is None


def test_ttl_is_strict(spark):
    df = spark.createDataFrame([(1, T0 - dt.timedelta(hours=2)), (2, T0 - dt.timedelta(hours=2) + dt.timedelta(milliseconds=1))], "id int, created_at timestamp_ntz")
    assert [r["id"] for r in Q.drop_expired(df, F.lit(T0).cast("timestamp_ntz")).collect()] == [2]


@pytest.mark.parametrize("hot_rows", [0, None])
def test_budget_against_a_loop(spark, hot_rows):
    rnd = random.Random(11)
    rows = [(i, "hot" if i % 3 else "b", T0 + dt.timedelta(seconds=rnd.randint(0, 50)), "x" * rnd.choice([1, 40, 90, 120])) for i in range(800)]
    df = spark.createDataFrame(rows, "event_id int, key string, ts timestamp_ntz, item string")
    got = {r["event_id"] for r in Q.persist_budget(df, "item", "key", item_limit=100, total_limit=5000, hot_rows=hot_rows).collect()}
    want = set()
    for key in ("hot", "b"):
        total = 0
        for r in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            if len(r[3]) > 100:
                continue
            if total + len(r[3]) > 5000:
                break
            total += len(r[3])
            want.add(r[0])
    assert got == want
    whole = Q.persist_budget(df, "item", None, item_limit=100, total_limit=300)
    assert whole.agg(F.sum(F.length("item"))).first()[0] <= 300


@pytest.mark.parametrize("latest", [False, True])
@pytest.mark.parametrize("n", [1001, 1700, 5000])
def test_selection_of_many_rows(spark, n, latest):
    """Ties, a burst, rows without a time and repeated rows; counts are exact."""
    rnd = random.Random(n)
    rows = [(i // 2, rnd.choice(["k", "k", None]), None if i % 11 == 0 else T0 + dt.timedelta(seconds=rnd.choice([0, 7, 7, 7, rnd.randint(0, 999)]))) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id int, key string, ts timestamp_ntz")
    take = Q.keep_latest if latest else Q.take_front
    place = lambda r: (r[2] is not None, r[2] or T0, r[0])
    whole = sorted(rows, key=place, reverse=latest)
    assert sorted(map(place, take(df, n).collect())) == sorted(map(place, whole[:n]))
    got = take(df, n, "key").collect()
    for key in ("k", None):
        want = [r for r in whole if r[1] == key][:n]
        assert sorted(place(r) for r in got if r["key"] == key) == sorted(map(place, want))


def test_a_whole_queue_is_not_shuffled(spark):
    df, _ = _queue(spark)
    plan = Q.keep_latest(df, 900)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("hot_rows", [0, 100, 10**6])
def test_batches(spark, hot_rows):
    df, rows = _queue(spark)
    got = Q.assign_batches(df, "key", 10, hot_rows=hot_rows).collect()
    want = {r[0]: divmod(i, 10) for g in _by_key(rows).values() for i, r in enumerate(g)}
    assert {r["event_id"]: (r["batch_no"], r["pos"]) for r in got} == want


@pytest.mark.parametrize("order", [("ts", "event_id"), ("seq", "event_id")])
@pytest.mark.parametrize("null_share", [2, 3, 10**9])
def test_batches_of_a_hot_key_without_times(spark, order, null_share):
    rows = [(i, "k" if i % 4 else "other", None if i % null_share == 0 else (i * 37) % 50) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, key string, n long")
    df = df.withColumns({"ts": F.timestamp_seconds(F.col("n") * 1800), "seq": F.col("n") * 40_000})
    plain, hot = (
        {r["event_id"]: (r["batch_no"], r["pos"]) for r in Q.assign_batches(df, "key", 3, order=order, hot_rows=n).collect()}
        for n in (10**6, 0)
    )
    ranked = sorted((r for r in rows if r[1] == "k"), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
    assert {r[0]: divmod(i, 3) for i, r in enumerate(ranked)}.items() <= plain.items()
    assert hot == plain and len(hot) == 120


@pytest.mark.parametrize("hot_rows", [0, 10**6])
def test_batches_of_any_order(spark, hot_rows):
    rows = [(f"n{(i * 7) % 90:02}", "k") for i in range(90)]
    got = Q.assign_batches(spark.createDataFrame(rows, "name string, key string"), "key", 4, order=("name",), hot_rows=hot_rows).collect()
    assert {r["name"]: (r["batch_no"], r["pos"]) for r in got} == {f"n{i:02}": divmod(i, 4) for i in range(90)}


def test_batch_gate(spark):
    big, half = "x" * 262145, "y" * 131100
    rows = [(1, 0, "a"), (1, 1, "b"), (2, 0, half), (2, 1, half), (3, 0, big), (4, 0, big), (4, 1, "c"), (5, 0, "x" * 262144)]
    df = spark.createDataFrame(rows, "batch_id int, pos int, body string")
    sizes = {r["batch_id"]: r["batch_bytes"] for r in Q.batch_sizes(df).collect()}
    assert (sizes[1], sizes[3], sizes[5]) == (len('{"events":[a,b]}'), 262145, 262144)
    got = {(r["batch_id"], r["pos"]): r["gate"] for r in Q.batch_size_gate(df).collect()}
    assert [got[k] for k in sorted(got)] == ["send", "send", "split", "split", "failed", "failed", "split", "send"]
    strict = Q.batch_size_gate(df, split_oversized=False).filter("batch_id = 2").collect()
    assert {r["gate"] for r in strict} == {"failed"}


def test_delivery(spark):
    sent = spark.createDataFrame([(1, 0, 200, 0), (1, 1, 200, 3), (2, 0, 500, 2), (2, 1, 500, 3), (3, 0, None, 3)], "batch_id int, pos int, status int, retries int")
    acks = spark.createDataFrame([(1, 0, "id-1", "log"), (2, 0, "id-2", "log")], "batch_id int, pos int, ack_id string, ack_type string")
    res = Q.join_acks(sent, acks)
    got = {(r["batch_id"], r["pos"]): (r["success"], r["ack_id"]) for r in res.collect()}
    assert got == {(1, 0): (True, "id-1"), (1, 1): (True, None), (2, 0): (False, None), (2, 1): (False, None), (3, 0): (False, None)}
    out = {(r["batch_id"], r["pos"]): r["outcome"] for r in Q.reconcile_delivery(res).collect()}
    assert out == {(1, 0): "delivered", (1, 1): "delivered", (2, 0): "retry", (2, 1): "dropped", (3, 0): "dropped"}
    loose = Q.reconcile_delivery(res, flush_failed=F.col("status").isNull(), cap_always=False).filter("batch_id = 3").first()
    assert loose["outcome"] == "retry"
    stats = Q.delivery_stats(Q.reconcile_delivery(res)).first()
    assert (stats["queue_size"], stats["total_events"], stats["total_flushes"], stats["total_errors"]) == (1, 5, 1, 2)


def test_rejected_batches(spark):
    df = spark.createDataFrame([(1, 0, 400), (1, 1, 400), (2, 0, 401), (3, 0, None), (4, 0, 200)], "batch_id int, pos int, status int")
    rows = Q.split_rejected_batches(df).orderBy("batch_id", "pos").collect()
    assert [(r["next_step"], r["send_id"], r["error"]) for r in rows] == [
        ("resend_single", "1-0", None), ("resend_single", "1-1", None), ("failed", "2", "HTTP 401"), ("failed", "3", "no answer"), ("done", "4", None)]


def test_inspection(spark):
    df, _ = _queue(spark)
    drained, empty = Q.drain(df)
    assert drained.count() == 300 and Q.queue_sizes(empty).first()["is_empty"]
    first = Q.peek(df).first()
    assert first["ts"] == df.agg(F.min("ts")).first()[0]


# --- ordered helpers against plain windows -----------------------------------


@pytest.mark.parametrize("hot", [0, 150, 10**6])
def test_ordered_helpers_equal_plain_windows(spark, hot):
    from pyspark.sql import Window

    df, _ = _queue(spark, 500)
    df = df.withColumn("v", F.when(F.col("event_id") % 4 == 0, F.col("event_id")))
    w = Window.partitionBy("key").orderBy("ts", "event_id")
    cut = O.time_slice("ts")
    cases = [
        (O.number_rows(df, "key", ("ts", "event_id"), cut, "x", hot), F.row_number().over(w).cast("long")),
        (O.with_previous(df, "key", ("ts", "event_id"), {"event_id": "x"}, cut, hot), F.lag("event_id").over(w)),
        (O.with_last_known(df, "key", ("ts", "event_id"), {"x": F.col("v")}, cut, hot), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))),
        (O.with_earlier_max(df, "key", ("ts", "event_id"), F.col("v"), "x", cut, hot), F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))),
    ]
    cases += [(O.running(df, "key", ("ts", "event_id"), {"x": fold}, hot), plain) for fold, plain in [
        (O.count_rows(), F.row_number().over(w).cast("long")),
        (O.Sum(F.col("event_id")), F.sum("event_id").over(w)),
        (O.LastKnown(F.col("v")), F.last("v", True).over(w)),
        (O.EarlierMax(F.col("v")), F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))),
    ]]
    whole = Window.orderBy("ts", "event_id")
    cases.append((O.running(df, [], ("ts", "event_id"), {"x": O.Sum(F.col("event_id"))}, hot), F.sum("event_id").over(whole)))
    for got, plain in cases:
        want = df.withColumn("x", plain).select("event_id", "x")
        assert got.select("event_id", F.col("x").cast("long")).exceptAll(want).count() == 0
        assert got.count() == 500


def test_a_burst_is_cut(spark):
    """All rows at one moment: slices go by the rest of the order; nulls and repeated rows too."""
    rows = [(i // 2, "k", T0 if i % 5 else None, i % 9 == 0) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, key string, ts timestamp_ntz, good boolean")
    order = ("ts", "event_id")
    sliced, hot = O._sliced(df, ["key"], order, 100, None)
    sizes = [r["count"] for r in hot.groupBy("__slice").count().collect()]
    assert len(sizes) >= 16 and max(sizes) <= 150
    for n in (0, 100, 10**6):
        got = O.running(df.dropDuplicates(["event_id", "ts"]), "key", order, {"no": O.count_rows(), "since": O.SinceReset(F.col("good"))}, n).collect()
        since = 0
        for i, r in enumerate(sorted(got, key=lambda r: (r["ts"] is not None, r["event_id"])), 1):
            since = 0 if r["good"] else since + 1
            assert (r["no"], r["since"]) == (i, since)


# --- timers ------------------------------------------------------------------

MARK = "client string, name string, mark_id int, ts timestamp_ntz, kind string"


def _pairs_by_hand(marks):
    open_, out = {}, set()
    for c, n, i, ts, kind in sorted(marks, key=lambda m: (m[3], m[2])):
        if kind == "start":
            open_[c, n] = ts
        elif (c, n) in open_:
            out.add((c, n, i, open_.pop((c, n)), ts))
    return out


def random_marks(seed, n=400):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), rnd.choice(["x", "y"]), i, T0 + dt.timedelta(minutes=rnd.randint(0, 900)), rnd.choice(["start", "stop"])) for i in range(n)]


@pytest.mark.parametrize("hot_rows", [0, 10**6])
def test_pairs(spark, hot_rows):
    marks = random_marks(2)
    got = pair_timers(spark.createDataFrame(marks, MARK), hot_rows=hot_rows).collect()
    assert {(r["client"], r["name"], r["mark_id"], r["start_ts"], r["end_ts"]) for r in got} == _pairs_by_hand(marks)


def test_timer_rounding(spark):
    df = spark.createDataFrame([("n", 1.005, T0, T0), ("n", 2.675, T0, T0), ("n", 12.344, T0, T0)], "name string, duration_ms double, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = [r["performance"]["duration"] for r in timer_events(df).collect()]
    assert got == [int(x * 100 + 0.5) / 100 for x in (1.005, 2.675, 12.344)]


# --- signatures ----------------------------------------------------------------


def test_hmac_matches_the_standard_library(spark):
    cases = [(s, b) for s in ("k", "", "x" * 64, "y" * 65, "zażółć") for b in ("", "body", "naïve ✓")]
    df = spark.createDataFrame(cases, "secret string, body string")
    got = [r[0] for r in df.select(hmac_sha256_hex("secret", "body")).collect()]
    assert got == [hmac.new(s.encode(), b.encode(), hashlib.sha256).hexdigest() for s, b in cases]


def test_sign_and_verify(spark):
    secrets = spark.createDataFrame([("k1", "s1"), ("k2", "s2")], "key_id string, secret string")
    df = spark.createDataFrame([(1, "k1", '{"a":1}', 1000), (2, "k2", "{}", 1000), (3, "k9", "{}", 1000)], "id int, key_id string, body string, at long")
    signed = H.sign_bodies(df, secrets, "at")
    want = "v1=" + hmac.new(b"s1", b'1000.{"a":1}', hashlib.sha256).hexdigest()
    assert signed.filter("id = 1").first()["signature"] == want

    def statuses(d, now=1000):
        return [r["signature_status"] for r in H.verify_bodies(d, secrets, F.lit(now)).orderBy("id").collect()]

    assert statuses(signed) == ["ok", "ok", "unknown_key"]
    assert statuses(signed, 1300)[:2] == ["ok", "ok"] and statuses(signed, 1301)[:2] == ["stale", "stale"]
    assert statuses(signed.withColumn("body", F.concat("body", F.lit(" "))))[:2] == ["bad_signature"] * 2
    assert statuses(signed.withColumn("timestamp", F.lit("soon")))[:2] == ["bad_signature"] * 2
    packed = H.embed_signature(signed.filter("id < 3"))
    assert packed.filter("id = 2").first()["body"].startswith('{"__key":"k2"')
    out = H.verify_embedded(packed, secrets, F.lit(1000)).orderBy("id").collect()
    assert [r["signature_status"] for r in out] == ["ok", "ok"]
    assert H.verify_embedded(df.select("id", "body"), secrets, F.lit(1000)).filter("signature_status <> 'unsigned'").count() == 0


def test_secrets_stay_out_of_plans(spark):
    secrets = spark.createDataFrame([("k1", "very-secret-value")], "key_id string, secret string")
    df = spark.createDataFrame([("k1", "{}", 1)], "key_id string, body string, at long")
    plan = H.sign_bodies(df, secrets, "at")._jdf.queryExecution().toString()
    assert "very-secret-value" not in plan and "NestedLoop" not in plan


def _jitter(seed):
    h = 0
    units = seed.encode("utf-16-be")
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) % 2**32
    return h % 60


def test_jitter(spark):
    seeds = ["key_abc", "", "a", "zażółć", "😀 pair", "x" * 500]
    df = spark.createDataFrame([(s,) for s in seeds], "s string")
    assert [r[0] for r in df.select(jitter_minutes("s")).collect()] == [_jitter(s) for s in seeds]
    assert _jitter("key_abc") == 6


def test_fingerprint(spark):
    key = "Ab" * 32
    df = spark.createDataFrame([(key,), ("zz" * 32,), ("ab",), (None,)], "k string")
    want = hashlib.sha256(bytes.fromhex(key)).hexdigest()[:16]
    assert [r[0] for r in df.select(key_fingerprint("k")).collect()] == [want, None, None, None]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["start", "stop"])), max_size=30))
def test_previous_mark_rule(marks):
    """A pair is a stop right after a start of its key: the rule the batch operator uses."""
    rows = [("c", n, i, T0 + dt.timedelta(seconds=i), k) for i, (n, k) in enumerate(marks)]
    by_rule, last = set(), {}
    for c, n, i, ts, k in rows:
        if k == "stop" and last.get(n, (None, None))[0] == "start":
            by_rule.add((c, n, i, last[n][1], ts))
        last[n] = (k, ts)
    assert by_rule == _pairs_by_hand(rows)


def test_schema_is_exported():
    from signalloom import schemas

    assert isinstance(schemas.EVENT, T.StructType) and schemas.EVENT["_meta"].dataType["context"].dataType["pid"].dataType == T.LongType()


@pytest.mark.parametrize("by", [["k"], []])
@pytest.mark.parametrize("from_end", [False, True])
def test_rows_without_a_weight_are_left_out_and_take_no_room(spark, by, from_end):
    rows = spark.range(400).select("id", (F.col("id") % 2).alias("k"), F.when(F.col("id") % 3 > 0, F.lit(5).cast("long")).alias("w"))
    kept = O.keep_within(rows, by, ["id"], F.col("w"), 100, from_end)
    want = set()
    for key in (0, 1) if by else (None,):
        ids = [i for i in range(400) if i % 3 and (key is None or i % 2 == key)]
        want |= set(ids[-20:] if from_end else ids[:20])
    assert {r["id"] for r in kept.collect()} == want
