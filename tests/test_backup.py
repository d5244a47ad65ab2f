import datetime as dt
import random
import gzip

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from signalloom.functions.hashing import jitter_minutes
from signalloom.limits import ARTIFACT_MAGIC
from signalloom.operators import schedule as B
from signalloom.operators import snapshots as A
from signalloom.plans.backup_queries import limit_of, statuses
from signalloom.sources import artifacts as S
from signalloom.sources import backup_io, blocklist_io, database, spool

KEY, OTHER = "0f" * 32, "f0" * 32
NOW = dt.datetime(2026, 8, 8, 2, 10)
POLICY = (
    "project_id int, api_key string, enabled boolean, interval_hours int, preferred_hour_utc int, run_now_at string, "
    "last_success_at timestamp_ntz, last_attempt_at timestamp_ntz, handled_run_now_at string, want string"
)


def _ago(now, hours=0, minutes=0):
    return now - dt.timedelta(hours=hours, minutes=minutes)


def _decide(spark, rows, now):
    df = spark.createDataFrame([(i, "key_abc", *r) for i, r in enumerate(rows)], POLICY)
    return B.backup_due(df, F.lit(now)).orderBy("project_id").collect()


def test_decisions(spark):
    n = NOW  # the jitter of key_abc is 6, so the window is 02:06 to 03:06
    rows = [
        (None, None, None, None, None, None, None, "no policy"),
        (False, 24, 2, "r1", None, None, None, "backups are off"),
        (True, 24, 2, "r1", None, _ago(n, minutes=1), None, "requested by hand"),
        (True, 24, 2, "r1", _ago(n, 3), None, "r1", "interval not over"),
        (True, 24, 2, "", _ago(n, 3), None, None, "interval not over"),
        (True, 24, 2, None, None, None, None, "no copy yet"),
        (True, 24, 2, None, None, _ago(n, minutes=29), None, "last attempt too recent"),
        (True, 24, 2, None, None, _ago(n, minutes=30), None, "no copy yet"),
        (True, 24, 2, None, _ago(n, 30), None, None, "interval over"),
        (True, 24, 14, None, _ago(n, 25), None, None, "outside the preferred window"),
        (True, 24, 14, None, _ago(n, 48), None, None, "interval over"),
        (True, 6, 14, None, _ago(n, 7), None, None, "interval over"),
        (True, 6, 14, None, _ago(n, 5), None, None, "interval not over"),
    ]
    out = _decide(spark, rows, n)
    assert [r["reason"] for r in out] == [r["want"] for r in out]
    assert [r["trigger"] for r in out if r["reason"] == "requested by hand"] == ["MANUAL"]
    assert all(r["run"] == (r["trigger"] is not None) for r in out)


def test_window_ends_at_midnight(spark):
    late, early = dt.datetime(2026, 8, 8, 23, 59), dt.datetime(2026, 8, 9, 0, 1)
    for now, want in ((late, "interval over"), (early, "outside the preferred window")):
        assert _decide(spark, [(True, 24, 23, None, _ago(now, 25), None, None, want)], now)[0]["reason"] == want


def test_ledger(spark):
    t = lambda m: NOW + dt.timedelta(minutes=m)
    rows = [
        ("p", "r1", t(0), "start", 200, None, None, None, None), ("p", "r1", t(1), "heartbeat", None, None, None, None, None),
        ("p", "r1", t(9), "final", None, "UPLOADED", 10, "c", None), ("p", "r2", t(5), "start", 409, None, None, None, None),
        ("p", "r3", t(6), "start", 200, None, None, None, None), ("p", "r3", t(8), "final", None, "FAILED", None, None, "boom"),
        ("p", "r3", t(12), "final", None, "UPLOADED", 1, "x", None), ("q", "r4", t(0), "start", 200, None, None, None, None)]
    df = spark.createDataFrame(rows, "project_id string, run_id string, ts timestamp_ntz, kind string, status int, outcome string, size_bytes long, checksum string, error string")
    led = B.run_ledger(df)
    got = {r["run_id"]: r for r in led.collect()}
    assert {k: r["run_status"] for k, r in got.items()} == {"r1": "UPLOADED", "r2": "REFUSED", "r3": "FAILED", "r4": "RUNNING"}
    assert got["r2"]["refused_status"] == 409 and got["r3"]["error"] == "boom" and got["r3"]["final_reports"] == 2
    state = {r["project_id"]: (r["last_attempt_at"], r["last_success_at"]) for r in B.state_from_ledger(led).collect()}
    assert state == {"p": (t(6), t(9)), "q": (t(0), None)}
    for hot in (0, 10**6):
        assert [r["run_id"] for r in B.overlapping_runs(led, hot_rows=hot).collect()] == ["r3"]


@pytest.mark.parametrize("hot_rows", [0, 10**6])
def test_admission_against_a_loop(spark, hot_rows):
    """Ties, runs of no length and without an end, repeats, missing keys."""
    rnd = random.Random(4)
    t = lambda m: NOW + dt.timedelta(minutes=m)
    rows = []
    for i in range(260):
        start = rnd.randint(0, 300)
        end = None if i == 250 else t(start + rnd.choice([-1, 0, 0, 1, 7, 30]))
        rows.append((rnd.choice("aab"), f"r{rnd.randint(0, 999):03}{i}", t(start), end))
    rows += rows[:20] + [("solo", "x", t(5), None), ("solo", "y", t(900), t(901)), (None, "n", t(1), t(2)), ("a", "m", None, t(2))]
    df = spark.createDataFrame(rows, "project_id string, run_id string, requested_at timestamp_ntz, busy_until timestamp_ntz")
    want, busy = {}, {}
    for project, run, start, end in sorted({r for r in rows if r[0] and r[2]}, key=lambda r: (r[2], r[1])):
        holder, until = busy.get(project, (None, start))
        if start >= until:
            busy[project] = (run, max(end or dt.datetime(9999, 1, 1), start + dt.timedelta(microseconds=1)))
            want[project, run] = (201, None)
        else:
            want[project, run] = (409, holder)
    want |= {(None, "n"): (400, None), ("a", "m"): (400, None)}
    got = B.admit_runs(df, hot_rows=hot_rows).collect()
    assert len(got) == len(rows)
    assert {(r["project_id"], r["run_id"]): (r["start_status"], r["blocked_by"]) for r in got} == want
    assert B.admit_runs(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).select(
        "id", F.concat(F.lit("row "), F.col("id").cast("string"), F.lit(" ✓")).alias("text"), (F.col("id") / 7).alias("x"),
        F.timestamp_seconds(F.col("id") + 0.123456).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, F.array(F.col("id"))).alias("items"),
    )


@pytest.fixture(scope="module")
def stored(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("snap"))
    run = S.write_encrypted_snapshot(rows, path, KEY, 50, "s1", chunk_bytes=20_000)
    return path, run


def test_round_trip(spark, rows, stored):
    path, run = stored
    r = run.first()
    assert (r["run_status"], r["n_rows"]) == ("UPLOADED", 5000) and r["n_chunks"] > 8 and len(r["digest"]) == 64
    artifacts, manifest = S.read_snapshot(spark, path, "s1")
    back = A.restore_artifacts(artifacts, KEY, rows.schema)
    assert back.exceptAll(rows).count() == 0 and back.count() == 5000
    body = bytes(artifacts.first()["artifact"])
    assert body.startswith(ARTIFACT_MAGIC) and b"row 1" not in body and gzip.compress(b"")[:2] not in body[:22]
    assert manifest.filter("size_bytes <= 36").count() == 0


def test_key_stays_out_of_plans(spark, rows, stored):
    artifacts, _ = S.read_snapshot(spark, stored[0], "s1")
    for df in (A.build_artifacts(rows, KEY, "s"), A.open_artifacts(artifacts, KEY)):
        plan = df._jdf.queryExecution().toString()
        assert KEY not in plan and KEY.upper() not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("key", [None, "", "abc", "g" * 64, "0f" * 31, "0f" * 32 + "\n"])
def test_no_key_no_snapshot(rows, key, tmp_path):
    with pytest.raises(A.InvalidKey):
        S.write_encrypted_snapshot(rows, str(tmp_path), key, 50, "s")
    assert list(tmp_path.iterdir()) == []


def test_damage(spark, stored):
    path, _ = stored
    artifacts, manifest = S.read_snapshot(spark, path, "s1")
    a = F.col("artifact")
    forms = {
        "ok": a,
        "foreign_magic": F.concat(F.encode(F.lit("OTHERMAG"), "UTF-8"), F.expr("substring(artifact, 9)")),
        "short_header": F.substring(a, 1, 19),
        "missing_tag": F.substring(a, 1, 35),
        "authentication_failed": F.concat(F.substring(a, 1, 50), F.unhex(F.lit("00ff00ff")), F.expr("substring(artifact, 55)")),
    }
    one = artifacts.limit(1)
    for want, form in forms.items():
        got = A.open_artifacts(one.withColumn("artifact", form), KEY).first()["artifact_status"]
        assert got == want
    assert A.open_artifacts(one, OTHER).first()["artifact_status"] == "authentication_failed"
    assert A.open_artifacts(one.withColumn("artifact", F.lit(None).cast("binary")), KEY).first()["artifact_status"] == "short_header"

    some = artifacts.withColumn("artifact", F.when(F.col("chunk_id").endswith("000001"), F.substring(a, 1, 40)).otherwise(a))
    with pytest.raises(PySparkException, match="authentication_failed"):
        A.restore_artifacts(some, KEY, spark.range(1).schema).collect()
    table = A.verify_artifacts(some.filter("chunk_id <> '000003-000000'"), KEY, manifest)
    counts = {r["artifact_status"]: r["count"] for r in table.groupBy("artifact_status").count().collect()}
    assert set(counts) == {"ok", "authentication_failed", "missing"}
    assert sum(counts.values()) == manifest.count()
    wrong = manifest.withColumn("checksum", F.lit("0"))
    assert {r["artifact_status"] for r in A.verify_artifacts(artifacts, KEY, wrong).collect()} == {"checksum_mismatch"}
    assert A.verify_artifacts(artifacts, KEY).filter("artifact_status <> 'ok' or plaintext_bytes is null").count() == 0


def test_size_limit(spark, tmp_path):
    noise = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 512).alias("h"))
    run = S.write_encrypted_snapshot(noise, str(tmp_path), KEY, 1, "big", chunk_bytes=200_000).first()
    assert run["run_status"] == "FAILED" and run["ciphertext_bytes"] > 1 << 20
    with pytest.raises(A.SnapshotError):
        S.read_snapshot(spark, str(tmp_path), "big")


def test_limit_is_at_least_one_megabyte(spark):
    m = spark.createDataFrame([("s", "c", "x", 1, 1048576 + 36), ("t", "c", "x", 1, 1048577 + 36)], "snapshot_id string, chunk_id string, checksum string, n_rows long, size_bytes long")
    got = {r["snapshot_id"]: r["run_status"] for r in A.artifact_size_gate(m, 0).collect()}
    assert got == {"s": "UPLOADED", "t": "FAILED"}


def test_artifacts_as_files(spark, stored, tmp_path):
    artifacts, _ = S.read_snapshot(spark, stored[0], "s1")
    for r in artifacts.limit(3).collect():
        (tmp_path / r["chunk_id"]).write_bytes(bytes(r["artifact"]))
    files = S.read_artifacts(spark, str(tmp_path))
    assert {r["artifact_status"] for r in A.verify_artifacts(files, KEY).collect()} == {"ok"} and files.count() == 3


def test_state_files(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"project_id":"a","lastSuccessAt":"2024","lastAttemptAt":5,"handledRunNowAt":null,"x":1}\n'
        '{"project_id":"b","lastSuccessAt":true,"lastAttemptAt":{"y":1}}\nbroken\n'
    )
    state = backup_io.read_backup_state(spark, str(tmp_path))
    assert {tuple(r) for r in state.collect()} == {("a", "2024", None, None), ("b", None, None, None)}
    patch = spark.createDataFrame([("a", None, "now"), ("c", "s", None)], "project_id string, last_success_at string, last_attempt_at string")
    out = {tuple(r) for r in backup_io.upsert_backup_state(state, patch).collect()}
    assert out == {("a", "2024", "now", None), ("b", None, None, None), ("c", "s", None, None)}
    with pytest.raises(ValueError, match="lastSuccessAt"):
        backup_io.upsert_backup_state(state, patch.withColumnRenamed("last_success_at", "lastSuccessAt"))


def test_decision_from_stored_files(spark, tmp_path):
    """Policies and states as stored; unreadable times let the backup run."""
    (tmp_path / "p").mkdir()
    (tmp_path / "s").mkdir()
    policy = '{{"project_id":"{}","enabled":true,"intervalHours":6,"preferredHourUtc":3,"fetchedAt":1}}'
    (tmp_path / "p" / "p.json").write_text("\n".join(policy.format(p) for p in "abcd"))
    (tmp_path / "s" / "s.json").write_text(
        '{"project_id":"a","lastSuccessAt":"2024-01-31T02:00:00Z"}\n'
        '{"project_id":"b","lastSuccessAt":"garbage"}\n{"project_id":"c","lastSuccessAt":"2024-01-30T02:00:00Z","lastAttemptAt":"?"}\n'
    )
    rows = B.join_state(
        backup_io.read_backup_policy(spark, str(tmp_path / "p")), backup_io.read_backup_state(spark, str(tmp_path / "s"))
    ).withColumn("api_key", F.col("project_id"))
    got = {r["project_id"]: r["reason"] for r in B.backup_due(rows, F.lit("2024-01-31 02:10:00")).collect()}
    assert got == {"a": "interval not over", "b": "interval over", "c": "interval over", "d": "no copy yet"}
    with pytest.raises(ValueError, match="last_success_at"):
        B.backup_due(rows.drop("last_success_at"), F.lit("2024-01-31 02:10:00"))


def test_policy_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"project_id":"a","enabled":true,"intervalHours":6,"fetchedAt":1}\n{"project_id":"a","enabled":false,"intervalHours":24,"fetchedAt":2}\n'
    )
    row = backup_io.read_backup_policy(spark, str(tmp_path)).first()
    assert (row["enabled"], row["interval_hours"]) == (False, 24)


def test_blocklist_files(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame(
        [("ENFORCE", [("IP", "1.1.1.1", "2024-01-01T00:00:00Z"), ("IP", "2.2.2.2", "never"), ("IP", "3.3.3.3", None)], 1000),
         (None, [], 2000), ("OFF", None, 3000), ("", [], 4000)],
        "mode string, entries array<struct<type:string,value:string,expiresAt:string>>, fetchedAt long",
    )
    blocklist_io.append_blocklist_snapshot(df.filter("fetchedAt < 2500"), path)
    blocklist_io.append_blocklist_snapshot(df.filter("fetchedAt > 2500"), path)
    (row,) = blocklist_io.read_blocklist_snapshots(spark, path).collect()
    assert row["fetched_at"] == dt.datetime(1970, 1, 1, 0, 0, 1)
    assert [e["expires_at"] for e in row["entries"]] == [dt.datetime(2024, 1, 1), None, None]
    assert blocklist_io.latest_snapshot(blocklist_io.read_blocklist_snapshots(spark, path)).first()["mode"] == "ENFORCE"


def test_jdbc_target():
    url, props = database.jdbc_target("postgresql://us%40er:p%2Fw@db.example.com:6543/my%20db?sslmode=require")
    assert url == "jdbc:postgresql://db.example.com:6543/my db"
    assert props == {"driver": "org.postgresql.Driver", "user": "us@er", "password": "p/w", "sslmode": "require"}
    assert "p/w" not in url
    with pytest.raises(ValueError):
        database.jdbc_target("not a url")


def test_jdbc_read_is_partitioned(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, **kw):
        seen.update(url=url, table=table, **kw)
        return spark.range(1)

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.jdbc", jdbc)
    database.read_database_table(spark, "postgres://u:p@h/d", "orders", "id", (0, 10**9), 200)
    assert (seen["numPartitions"], seen["column"], seen["properties"]["password"]) == (200, "id", "p")
    with pytest.raises(ValueError):
        database.read_database_table(spark, "postgres://u:p@h/d", "orders", "id")


def test_spool(spark, tmp_path):
    df = spark.createDataFrame([(1, NOW, '{"password":"x"}'), (2, NOW - dt.timedelta(hours=3), "{}"), (3, NOW, '"' + "y" * 8200 + '"')], "event_id int, ts timestamp_ntz, item_json string")
    spool.write_spool(df, str(tmp_path / "q"), None)
    got = spool.read_spool(spark, str(tmp_path / "q"), F.lit(NOW).cast("timestamp_ntz"))
    # the third item is cut by redaction to 8,192 characters and a marker, still over the item limit
    assert [(r["event_id"], r["item_json"]) for r in got.collect()] == [(1, '{"password":"[REDACTED]"}')]
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in got._jdf.queryExecution().executedPlan().toString()


def test_jitter_is_in_range(spark):
    df = spark.range(500).select(jitter_minutes(F.col("id").cast("string")).alias("j"))
    assert df.filter("j < 0 or j > 59").count() == 0


def test_the_limit_of_a_policy_grows_with_the_table(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("noise"))
    runs = [
        S.write_encrypted_snapshot(rows, str(tmp_path), KEY, mb, name, 100_000).first()["run_status"]
        for name, mb in (("fixed", limit_of(rows.limit(1), 1)), ("grown", limit_of(rows, 1, 10_000)))
    ]
    assert runs == ["FAILED", "UPLOADED"]
    assert [limit_of(spark.range(n)) for n in (0, 1_000_000, 1_000_001)] == [512, 512, 1024]


def test_a_document_without_text_has_an_artifact(spark, tmp_path):
    docs = spark.createDataFrame([(i, None if i < 6 else "text") for i in range(12)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r["artifact_status"] for r in statuses(spark, str(tmp_path)).collect()}
    assert [found[i] for i in range(6, 12)] == ["ok", "foreign_magic", "short_header", "missing_tag", *["authentication_failed"] * 2]
    assert [found[i] for i in range(5)] == [found[i] for i in range(6, 11)]
    assert found[5] == "missing_tag"  # of an empty text not even the tag is whole


def test_contents_are_measured_one_by_one():
    held = pa.array([gzip.compress(b"x" * 1000), b"broken", None, gzip.compress(b"")], pa.binary())
    assert A._plain_bytes.func(held).to_pylist() == [1000, None, None, 0]
