"""Queries whose operators must meet every event of the table."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import __spark_entry__ as driver
from signalloom.functions.text import truncate_text
from signalloom.operators import sizing

SF_DIR = "/root/testdata/sf0.001"


def test_every_event_gives_a_list_version(spark):
    queries = driver.queries()
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    read = queries["S4_blocklist_snapshots_all"](spark, SF_DIR)
    assert read.count() == events.where("event_id % 3 > 0 and event_id % 7 > 0").count()
    matched = queries["F11_match_point_in_time_all"](spark, SF_DIR).agg(
        F.count("req_id"), F.count_distinct("valid_from"), F.count_distinct("mode"), F.count_distinct("matched_value")
    )
    n, versions, modes, values = matched.first()
    assert n == events.count() and versions > n / 2 and modes == 3 and values == 3


def test_every_event_reaches_timer_pairing(spark):
    queries = driver.queries()
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    stops = queries["T1_pair_timers_all"](spark, SF_DIR).join(events, F.col("mark_id") == F.col("event_id"))
    assert {r[0] for r in stops.select("event_type").distinct().collect()} == {"purchase", "error"}
    starts = queries["T1_pair_timers_all"](spark, SF_DIR).join(events.withColumnRenamed("ts", "at"), F.col("start_ts") == F.col("at"))
    assert {r[0] for r in starts.select("event_type").distinct().collect()} == {"click", "view", "signup"}


def test_no_task_gets_more_rows_than_its_bound(spark, tmp_path, monkeypatch):
    # one row group, which Spark reads in one task into however many parts it cuts the file
    pq.write_table(pa.table({"n": list(range(20_000))}), f"{tmp_path}/events.parquet")
    monkeypatch.setattr(sizing, "COUNTED_BYTES", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = sizing.spread(spark.read.parquet(f"{tmp_path}/events.parquet"), max_rows=1000)
        held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(held) == 20_000 and max(held) <= 1100


def test_a_cut_text_is_made_once(spark):
    rows = spark.createDataFrame([("x" * 40,)], "s string")
    plan = rows.select(truncate_text(F.regexp_replace("s", "x", "y"), 10).alias("s"))
    assert plan.first()["s"] == "y" * 10 + "... [truncated, total 40 chars]"
    assert str(plan._jdf.queryExecution().optimizedPlan()).count("regexp_replace") == 1
