import datetime as dt
import random
import time
import tracemalloc

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from signalloom.operators.delivery import flush_batches
from signalloom.operators.timers import pair_timers
from signalloom.sources.scratch import materialize, scratch_root
from signalloom.streaming.enforcement import stream_match
from signalloom.streaming.flush import stream_flushes
from signalloom.streaming.state import AT, CLOCK, Packing, in_order, with_time
from signalloom.streaming.timers import stream_pairs
from signalloom.streaming.triggers import FlushListener, available_now, drop_expired_stream, micro_batches
from tests.test_delivery import MARK, T0, random_marks

EPOCH = dt.datetime(1970, 1, 1)


def _run(writer, checkpoint):
    available_now(writer).option("checkpointLocation", str(checkpoint)).start().awaitTermination()


@pytest.mark.parametrize("lifetime_ms", [None, 60 * 60_000])
def test_pairs_across_batches_and_restarts(spark, tmp_path, lifetime_ms):
    marks = sorted(random_marks(9, 300), key=lambda m: (m[3], m[2]))
    src, out = tmp_path / "in", tmp_path / "out"
    for i in range(4):  # each run starts anew from its checkpoint
        spark.createDataFrame(marks[i * 75 : (i + 1) * 75], MARK).write.mode("append").parquet(str(src))
        paired = stream_pairs(spark.readStream.schema(MARK).parquet(str(src)), lifetime_ms)
        _run(micro_batches(paired).format("parquet").option("path", str(out)), tmp_path / "cp")
    got = spark.read.schema(paired.schema).parquet(str(out))
    want = pair_timers(spark.createDataFrame(marks, MARK))
    if lifetime_ms:
        assert 0 < want.where(f"duration_ms > {lifetime_ms}").count()
        want = want.where(f"duration_ms <= {lifetime_ms}")
    assert got.count() == want.count() > 10
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_expired_starts_leave_the_state(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    day = dt.timedelta(days=1)
    parts = [[(c, "x", 1, T0, "start") for c in "abcdefgh"], [("z", "x", 2, T0 + day, "start")], [("z", "x", 3, T0 + 2 * day, "other"), ("a", "x", 4, T0 + 2 * day, "stop")]]
    kept = []
    for part in parts:
        spark.createDataFrame(part, MARK).write.mode("append").parquet(src)
        paired = stream_pairs(spark.readStream.schema(MARK).parquet(src), 3_600_000)
        _run(micro_batches(paired).format("parquet").option("path", str(tmp_path / "out")), cp)
        kept.append(spark.read.format("statestore").option("stateVarName", "open").load(cp).count())
    assert kept == [8, 1, 0]
    assert spark.read.schema(paired.schema).parquet(str(tmp_path / "out")).count() == 0


ARRIVAL = "client string, ts timestamp_ntz, event_id int, urgent boolean, body string"


def _flushes_by_hand(events, size, interval_ms):
    out = {}
    for client in {e[0] for e in events}:
        held, number, tick = [], 0, None

        def send(reason, at):
            nonlocal held, number
            number += 1
            for pos, e in enumerate(held):
                out[client, e[2]] = (number, pos, reason, at, e[4])
            held = []

        for e in sorted((e for e in events if e[0] == client), key=lambda e: (e[1], e[2])):
            now = int((e[1] - EPOCH) / dt.timedelta(milliseconds=interval_ms))
            if held and now > tick:
                send("timer", EPOCH + dt.timedelta(milliseconds=(tick + 1) * interval_ms))
            tick = now
            held.append(e)
            if len(held) == size or e[3]:
                send("full" if len(held) == size else "urgent", e[1])
        if held:
            send("timer", EPOCH + dt.timedelta(milliseconds=(tick + 1) * interval_ms))
    return out


def test_flushes(spark, tmp_path):
    """Full, urgent and timed batches across restarts; the batch form gives the same."""
    rnd = random.Random(3)
    events = [(rnd.choice("ab"), T0 + dt.timedelta(milliseconds=500 * rnd.randint(0, 150)), i, rnd.random() < 0.05, f"b{i}") for i in range(240)]
    want = _flushes_by_hand(events, 4, 5000)
    assert {v[2] for v in want.values()} == {"full", "urgent", "timer"}
    batch = flush_batches(spark.createDataFrame(events, ARRIVAL), "client", urgent=F.col("urgent"), size=4)
    assert {(r["client"], r["event_id"]): (r["batch_no"], r["pos"], r["reason"], r["flushed_at"], r["body"]) for r in batch.collect()} == want
    events.sort(key=lambda e: (e[1], e[2]))
    last = [("end", T0 + dt.timedelta(days=1), -1, True, None)]
    src = str(tmp_path / "in")
    for part in (events[:100], events[100:170], events[170:], last):
        spark.createDataFrame(part, ARRIVAL).write.mode("append").parquet(src)
        rows = spark.readStream.schema(ARRIVAL).parquet(src)
        sent = stream_flushes(rows, ("client",), columns=("body",), urgent=F.col("urgent"), size=4)
        _run(micro_batches(sent).format("parquet").option("path", str(tmp_path / "out")), tmp_path / "cp")
    got = spark.read.schema(sent.schema).parquet(str(tmp_path / "out")).where("client <> 'end'").collect()
    assert {(r["client"], r["event_id"]): (r["batch_no"], r["pos"], r["reason"], r["flushed_at"], r["body"]) for r in got} == want


def test_refreshed_list_is_used_by_the_next_batch(spark, tmp_path):
    entry = "pos int, type string, value string, expires_at timestamp_ntz"
    lists = iter([[(1, "IP", "1.1.1.1", None)], [(1, "IP", "2.2.2.2", None)]])
    src, seen = tmp_path / "in", []

    def sink(batch, batch_id):
        seen.append([(r["ip"], r["action"]) for r in batch.orderBy("ip").collect()])

    for _ in range(2):
        spark.createDataFrame([("1.1.1.1",), ("2.2.2.2",)], "ip string").coalesce(1).write.mode("append").parquet(str(src))
        reqs = spark.readStream.schema("ip string").parquet(str(src)).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
        _run(stream_match(reqs, lambda: spark.createDataFrame(next(lists), entry), sink), tmp_path / "cp")
    assert seen == [[("1.1.1.1", "block"), ("2.2.2.2", "pass")], [("1.1.1.1", "pass"), ("2.2.2.2", "block")]]


def test_expiry_in_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select 1 id, cast(current_timestamp() as timestamp_ntz) created_at union all select 2, timestamp_ntz'2020-01-01 00:00:00'").write.parquet(src)
    fresh = drop_expired_stream(spark.readStream.schema("id int, created_at timestamp_ntz").parquet(src))
    _run(micro_batches(fresh).format("parquet").option("path", str(tmp_path / "out")), tmp_path / "cp")
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_flush_callback(spark, tmp_path):
    flushed = []
    listener = FlushListener(on_success=flushed.append)
    spark.streams.addListener(listener)
    try:
        spark.range(7).write.parquet(str(tmp_path / "in"))
        rows = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        _run(micro_batches(rows).format("parquet").option("path", str(tmp_path / "out")), tmp_path / "cp")
        for _ in range(50):
            if flushed:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(flushed) == 7


def test_shared_folder_is_used(spark, tmp_path):
    class Clustered:
        conf = {"spark.checkpoint.dir": str(tmp_path) + "/"}
        sparkContext = None  # noqa: N815

    assert scratch_root(Clustered) == str(tmp_path)
    assert scratch_root(spark) == scratch_root(spark)
    assert materialize(spark.range(5), "x").count() == 5


def test_no_local_folder_on_a_cluster():
    class Remote:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        scratch_root(Remote)


def test_rows_of_a_key_are_sorted_in_bounded_memory():
    n = 300_000
    rows = (Row(**{AT: i * 7919 % n, "id": i, "pad": f"{i:0200d}"}) for i in range(n))
    tracemalloc.start()
    try:
        last, count = -1, 0
        for at, number, _pad in in_order(rows, ("id",), ("id", "pad"), memory_mb=1):
            assert at > last and at == number * 7919 % n
            last, count = at, count + 1
        _now, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    # all of them as sorted() holds them take more than 150 MB
    assert count == n and peak < 80e6


def test_rows_of_a_key_and_batch_travel_as_lists(spark):
    marks = random_marks(4, 3000)
    keys = {m[:2] for m in marks}
    packing = Packing(("client", "name"), ("mark_id",), ("kind",))
    timed = with_time(spark.createDataFrame(marks, MARK), "ts")
    want = {k: sorted((round((m[3] - EPOCH) / dt.timedelta(microseconds=1)), m[2], m[4]) for m in marks if m[:2] == k) for k in keys}
    assert packing.pack(timed, "1 minute").count() == len(keys) < 100
    for size, piece in ((1 << 26, 1 << 16), (1 << 26, 7)):
        packed = packing.pack(timed, "1 minute", size, piece).collect()
        assert all(len(r[3]) <= piece and round(r[CLOCK].timestamp() * 1e6) >= r[3][-1] for r in packed)
        got = {k: list(packing.unpacked((r for r in packed if r[:2] == k), 0)) for k in keys}
        assert got == want
    first = want[min(keys)]
    late = first[len(first) // 2][0] // 1000
    got = packing.unpacked((r for r in packed if r[:2] == min(keys)), late)
    assert list(got) == [m for m in first if m[0] > late * 1000] != first


def test_ties_without_ids_and_late_marks(spark, tmp_path):
    """Marks of one time are ordered although one has no id; a late one does not close what is open."""
    at = [T0 + dt.timedelta(minutes=m) for m in range(60)]
    parts = [
        [("a", "x", 1, at[0], "start"), ("a", "x", None, at[0], "stop"), ("b", "x", 2, at[30], "start")],
        [("b", "x", 3, at[10], "stop"), ("b", "x", 4, at[40], "stop"), ("c", "x", 5, at[5], "start"), ("c", "x", 6, at[41], "stop")],
    ]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in parts:
        spark.createDataFrame(part, MARK).write.mode("append").parquet(src)
        paired = stream_pairs(spark.readStream.schema(MARK).parquet(src))
        _run(micro_batches(paired).format("parquet").option("path", out), tmp_path / "cp")
    got = {(r["client"], r["mark_id"], r["start_ts"], r["end_ts"]) for r in spark.read.schema(paired.schema).parquet(out).collect()}
    assert got == {("a", None, at[0], at[0]), ("b", 4, at[30], at[40])}
