import datetime as dt

import pytest
from pyspark.sql import functions as F

from signalloom.functions import text as X
from signalloom.functions.delay import next_attempt, next_poll, retry_schedule
from signalloom.functions.net import connection_properties, os_family
from signalloom.operators import events as E
from signalloom.sources import events_io


def _now():
    return F.lit("2024-01-31 02:10:00").cast("timestamp_ntz")


def test_log_defaults(spark):
    df = spark.createDataFrame(
        [("hello", None, None, None), ("pwd=x", "", "", '{"token":1}'), ("m", "WARN", "svc", None)],
        "message string, level string, source string, metadata string",
    )
    rows = E.normalize_log(df, now=_now()).select("message", "level", "source", "metadata", "timestamp").collect()
    assert tuple(rows[0]) == ("hello", "INFO", "app", None, "2024-01-31T02:10:00.000Z")
    assert tuple(rows[1])[:4] == ("pwd=[REDACTED]", "INFO", "app", '{"token":"[REDACTED]"}')
    assert tuple(rows[2])[:3] == ("m", "WARN", "svc")


def test_bare_message_is_enough(spark):
    row = E.normalize_log(spark.createDataFrame([("x",)], "message string")).first()
    assert (row["level"], row["source"]) == ("INFO", "app") and row["timestamp"].endswith("Z")


def test_error_defaults_and_order_of_cut(spark):
    long = "a" * 12_000
    df = spark.createDataFrame(
        [("m", None, "", "", None, "E"), (long, "NETWORK", "LOW", "token: q", "2020", "E"), ("boom", "X", "HIGH", None, None, "TypeError")],
        "message string, error_type string, severity string, stack string, timestamp string, name string",
    )
    rows = E.normalize_error(df, exception=F.col("name") == "TypeError", now=_now()).collect()
    assert (rows[0]["error_type"], rows[0]["severity"], rows[0]["stack"]) == ("UNKNOWN", "MEDIUM", None)
    assert rows[1]["message"] == "a" * 8192 + "... [truncated 3808 chars]"
    assert (rows[1]["stack"], rows[1]["timestamp"]) == ("token: [REDACTED]", "2020")
    assert (rows[2]["error_type"], rows[2]["severity"], rows[2]["stack"]) == ("RUNTIME", "MEDIUM", "TypeError: boom")
    assert rows[2]["metadata"] == '{"name":"TypeError"}'


def test_levels(spark):
    df = spark.createDataFrame([("log", "DEBUG"), ("log", None), ("log", "odd"), ("log", "ERROR"), ("error", None)], "type string, level string")
    got = E.filter_min_level(df, "WARN").collect()
    assert [tuple(r) for r in got] == [("log", "ERROR"), ("error", None)]
    assert E.filter_min_level(df, "INFO").filter("level is null").count() == 2
    assert E.filter_min_level(df, "DEBUG").count() == 5
    with pytest.raises(ValueError):
        E.with_level(df, "LOUD")


def test_sampling(spark):
    df = spark.range(10_000)
    assert E.sample_events(df, 1.0).count() == 10_000
    assert E.sample_events(df, 0.0).count() == 0
    kept = E.sample_events(df, 0.25, by="id")
    assert 2300 < kept.count() < 2700
    assert kept.exceptAll(E.sample_events(df, 0.5, by="id")).count() == 0
    assert 2300 < E.sample_events(df, 0.25, seed=1).count() < 2700


def test_tags_merge_without_session_policy(spark):
    df = spark.sql("select map('a','1','b','2') t, map('b','9','c','3') g")
    assert df.select(E.merge_tags("t", "g")).first()[0] == {"a": "1", "b": "9", "c": "3"}
    assert df.select(E.merge_tags("t", None)).first()[0] == {"a": "1", "b": "2"}


def test_hook_errors_keep_the_event(spark):
    def hook(e):
        if e["id"] == 0:
            return False
        if e["id"] == 1:
            e["msg"] = "changed before the error"
            raise RuntimeError
        return {**e, "msg": "new"}

    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "id int, msg string")
    assert {tuple(r) for r in E.before_send(df, hook).collect()} == {(1, "b"), (2, "new")}


def test_chain(spark):
    seen = []
    chain = E.StageChain().use(lambda d: d.filter("id > 0")).use(lambda d: seen.append(1) or d.withColumn("x", F.col("id") + 1))
    assert chain.count == 2
    assert [r["x"] for r in chain.run(spark.range(3)).orderBy("id").collect()] == [2, 3]
    chain.clear()
    assert chain.count == 0 and chain.run(spark.range(3)).count() == 3


def test_console_json_arguments(spark):
    df = spark.createDataFrame([(["plain", '{"password":"x","n":1}'], "warn")], "args array<string>, console_level string")
    # elements that are JSON text are redacted by key when they are parsed as such
    parsed = df.withColumn("args", F.transform("args", lambda a: F.when(a.startswith("{"), a).otherwise(F.to_json(F.array(a)))))
    row = E.console_to_events(df).first()
    assert row["message"] == 'plain {"password":"[REDACTED]","n":1}' and row["level"] == "WARN"
    assert row["metadata"] == '{"autoCapture":true,"consoleLevel":"warn"}'
    assert parsed.count() == 1


def test_crashes(spark):
    df = spark.createDataFrame([("", None, "E", "f.js", 3, 4)], "message string, stack string, name string, filename string, lineno int, colno int")
    b = E.crash_to_events(df, "browser", "error").first()
    assert (b["message"], b["stack"], b["severity"]) == ("Uncaught error", "f.js:3:4", "HIGH")
    n = E.crash_to_events(df, "node", "error").first()
    assert (n["message"], n["stack"], n["severity"], n["metadata"]) == ("Uncaught exception", None, "CRITICAL", '{"name":"E","autoCapture":true}')
    r = E.crash_to_events(df.withColumn("message", F.lit(None).cast("string")), "node", "rejection").first()
    assert (r["message"], r["severity"]) == ("Unhandled Promise Rejection: Unhandled rejection", "HIGH")
    with pytest.raises(ValueError):
        E.crash_to_events(df, "edge", "error")


def test_immediate_and_status(spark):
    df = spark.createDataFrame([("log", "FATAL", None), ("log", "ERROR", None), ("error", None, "CRITICAL"), ("error", "FATAL", "HIGH"), ("security", None, None)], "type string, level string, severity string")
    assert [r["immediate"] for r in E.flag_immediate(df).collect()] == [True, False, True, False, True]
    codes = [200, 204, 400, 401, 429, 500, None, 302]
    df = spark.createDataFrame([(c,) for c in codes], "s int")
    got = df.select(E.classify_status("s"), E.classify_status("s", True)).collect()
    assert [r[0] for r in got] == ["ok", "ok", "permanent", "permanent", "retryable", "retryable", "retryable", "retryable"]
    assert got[2][1] == "split"


def test_os_families(spark):
    cases = [("Windows NT", "Windows", "Windows"), ("iPhone like Mac OS X", "macOS", "iOS"), ("Linux; Android", "Linux", "Android"), ("", "Unknown", "Unknown")]
    df = spark.createDataFrame(cases, "ua string, a string, b string")
    assert df.filter((os_family("ua") != F.col("a")) | (os_family("ua", False) != F.col("b"))).collect() == []


def test_clamps(spark):
    exact, over, wide = "a" * 2048, "a" * 2049, "é" * 1025
    got = spark.createDataFrame([(exact,), (over,), (wide,)], "m string").select(X.clamp_message("m")).collect()
    assert [r[0] for r in got] == [exact, "a" * 2048 + "... [truncated]", wide + "... [truncated]"]
    meta = spark.createDataFrame([('{"a":1}',), ('"' + "x" * 8191 + '"',), (None,)], "m string").select(X.clamp_metadata("m")).collect()
    assert [r[0] for r in meta] == ['{"a":1}', X.METADATA_DROPPED, None]


def test_clamp_tags(spark):
    k = "repeat('k', 70)"
    sql = f"""select 0 i, map('a', '1', {k}, repeat('v', 70)) m
      union all select 1, map(concat({k}, '1'), 'first', 'b', 'x', concat({k}, '2'), 'second')
      union all select 2, map_from_entries(transform(sequence(0, 24), i -> struct(lpad(i, 3, 't'), string(i))))
      union all select 3, cast(map() as map<string,string>) union all select 4, null"""
    got = [r["m"] for r in spark.sql(sql).select("i", X.clamp_tags("m").alias("m")).orderBy("i").collect()]
    assert got[0] == {"a": "1", "k" * 64: "v" * 64}
    assert got[1] == {"k" * 64: "second", "b": "x"}
    assert sorted(got[2].values(), key=int) == [str(i) for i in range(20)]
    assert got[3:] == [{}, None]


def test_deep_merge(spark):
    df = spark.sql("select named_struct('a',1,'o',named_struct('x',1,'y',2),'l',array(1)) t, named_struct('o',named_struct('y',cast(null as int),'z',5),'l',array(2,3),'n','new') s")
    m = df.select(X.deep_merge(F.col("t"), F.col("s"), df.schema["t"].dataType, df.schema["s"].dataType).alias("m")).first()["m"]
    assert m.asDict(recursive=True) == {"a": 1, "o": {"x": 1, "y": 2, "z": 5}, "l": [2, 3], "n": "new"}


def test_delays(spark):
    df = spark.createDataFrame([(0,), (1,), (5,)], "n int")
    assert [r[0] for r in df.select(next_attempt("n")).collect()] == [1000.0, 2000.0, 30000.0]
    assert [r[0] for r in df.select(next_poll("n")).collect()] == [45000.0, 90000.0, 300000.0]
    jittered = df.select(next_attempt("n", jitter=F.lit(0.5))).collect()
    assert [r[0] for r in jittered] == [1500.0, 2500.0, 30000.0]
    assert df.select(retry_schedule("n")).collect()[2][0] == [1000.0, 2000.0, 4000.0, 8000.0, 16000.0]
    assert df.select(retry_schedule("n")).collect()[0][0] == []


def test_connection_properties(spark):
    url = "postgresql://us%40er:p%3A+w@db.example.com:6543/my%20db?sslmode=require"
    row = spark.createDataFrame([(url,), ("nonsense",), ("postgres://h",)], "u string").select(connection_properties("u").alias("p")).collect()
    assert row[0]["p"].asDict() == {"host": "db.example.com", "port": 6543, "user": "us@er", "password": "p:+w", "database": "my db", "sslmode": "require"}
    assert all(v is None for v in row[1]["p"].asDict().values())
    assert row[2]["p"]["host"] == "h" and row[2]["p"]["database"] is None


def test_objects_only(spark):
    raw = ['{"type":"log","data":{"message":"m"}}', "[1]", '"text"', "{broken", "12", None, " {}"]
    good, bad = E.filter_object_events(spark.createDataFrame([(r,) for r in raw], "value string"))
    assert {r["value"] for r in good.collect()} == {raw[0], raw[6]} and bad.count() == 5


def test_read_events_keeps_broken_lines(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"type":"log","data":{"message":"m","metadata":{"a":[1,2]}}}\n{"type":\n')
    df = events_io.read_events(spark, str(tmp_path)).cache()  # the corrupt column needs a full parse
    rows = {r["type"]: r for r in df.collect()}
    assert rows["log"]["data"]["metadata"] == '{"a":[1,2]}'
    assert rows[None]["_corrupt_record"] == '{"type":'
    df.unpersist()


def test_envelopes(spark):
    df = spark.createDataFrame([(1, p, f'{{"n":{p}}}') for p in range(250)] + [(2, 0, '{"n":7}')], "batch_id long, pos int, body string")
    sent = events_io.write_batches(df)
    assert sorted((r["batch_id"], r["chunk"], r["n_events"]) for r in sent.collect()) == [(1, 0, 100), (1, 1, 100), (1, 2, 50), (2, 0, 1)]
    assert sent.filter("batch_id = 2").first()["body"] == '{"n":7}'
    back = events_io.explode_batches(sent.select("batch_id", "chunk", F.col("body").alias("value")))
    got = sorted((r["batch_id"], r["chunk"] * 100 + r["pos"], r["event_json"]) for r in back.collect())
    assert got == sorted((r["batch_id"], r["pos"], r["body"]) for r in df.collect())


def test_context(spark):
    hosts = spark.createDataFrame([(1, "h1")], "host_id int, hostname string")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "host_id int, message string")
    rows = E.enrich_context(df, {"environment": "test"}, {"t": "1"}, {"t": "2"}, hosts, now=_now()).orderBy("host_id").collect()
    ctx = rows[0]["_meta"]["context"]
    assert (ctx["environment"], ctx["hostname"], ctx["tags"]) == ("test", "h1", {"t": "2"})
    assert rows[1]["_meta"]["context"]["hostname"] is None
    assert E.enrich_context(df, now=_now()).first()["_meta"]["timestamp"] == "2024-01-31T02:10:00.000Z"


def test_user_context(spark):
    df = spark.createDataFrame([('{"id":"1","email":"bob@example.com","token":"x"}',)], "user string")
    assert E.user_context(df).first()["user"] == '{"id":"1","email":"*@example.com","token":"[REDACTED]"}'


def test_iso_and_ids(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 678901),)], "t timestamp_ntz")
    row = df.select(X.iso_time("t").alias("t"), X.event_id().alias("id")).first()
    assert row["t"] == "2024-01-02T03:04:05.678Z" and len(row["id"]) == 36
