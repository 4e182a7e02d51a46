"""Plan shapes and hot keys: what must hold when the tables are a thousand times larger."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions.clock import opened_on
from tidemark.operators import joins, scd, select
from tidemark.sources import tables

HASHED = "_keyhash string, _rowhash string, _valid_from timestamp_ntz, _valid_until timestamp_ntz, _valid_flag boolean"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_windows_reach_the_parquet_reader(events):
    plan = plan_of(opened_on(events, "ts", date(2024, 1, 30)).select("event_id"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,.*LessThan\(ts,", plan)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_closed_versions_are_not_shuffled_by_a_merge(spark, tmp_path, no_broadcast):
    hist = spark.createDataFrame(
        [(f"k{i}", f"r{i}", datetime(2024, 1, 1), datetime(2099, 12, 31), i % 2 == 0) for i in range(20)], HASHED
    ).withColumn("iso_code", F.substring("_keyhash", 2, 1))
    tables.write_scd(hist, str(tmp_path / "h"))
    stored = tables.read_scd(spark, str(tmp_path / "h"))
    staging = hist.limit(5).select("_keyhash", "_rowhash", "iso_code")
    merged = scd.scd2_merge(stored, staging, datetime(2024, 2, 1), scope=["iso_code"])
    plan = plan_of(merged)
    assert "BroadcastHashJoin" not in plan and "NestedLoop" not in plan
    first_child = re.split(r"\n   :- ", plan[plan.index("Union"):])[1]
    assert "Scan parquet" in first_child and "Exchange" not in first_child
    # Files of closed versions are skipped by their statistics when active ones are read.
    assert "EqualTo(_valid_flag,true)" in plan


def test_an_update_opens_no_file_of_closed_versions(spark, tmp_path):
    hist = spark.createDataFrame(
        [(f"k{i}", f"r{i}", datetime(2024, 1, 1), datetime(2024, 1, 9 + i % 2), i % 2 == 0) for i in range(20)], HASHED
    ).withColumn("iso_code", F.substring("_keyhash", 2, 1))
    tables.write_scd(hist, str(tmp_path / "h"))
    active = tables.read_scd(spark, str(tmp_path / "h"), "active")
    closed, opened = scd.scd2_changes(active, hist.limit(5), datetime(2024, 2, 1), scope=["iso_code"])
    for part in (closed, opened):
        assert re.search(r"PartitionFilters: \[.*version_state#\d+ = active", plan_of(part))
    read = {r[0] for r in active.select(F.input_file_name()).distinct().collect()}
    assert read and all("version_state=active" in f for f in read)


def test_delta_is_hash_joins_not_nested_loops(spark, no_broadcast):
    hist = spark.createDataFrame([("k", "r", datetime(2024, 1, 1), datetime(2099, 1, 1), True)], HASHED)
    plan = plan_of(scd.hash_delta(hist, hist))
    assert plan.count("SortMergeJoin") == 2 and "NestedLoop" not in plan


def test_one_row_per_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_of(select.best_per_key(df, ["k"], ["-v"]))
    assert "partial_min" in plan and "Window" not in plan


def test_hot_join_keys_are_split_at_run_time(spark, no_broadcast):
    """One key holds most rows; the skewed side is read by several tasks."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 10 < 8, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        dim = facts.select("k").withColumn("id", F.length("k"))
        joined = joins.lookup(facts, dim, [("k", "k")], "id", "found")
        assert joined.where("found is null").count() == 0
        done = joined.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("found").alias("f"))
        done.collect()
        assert "skew=true" in plan_of(done)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_versions_with_a_hot_key_are_all_kept(spark):
    """A key that holds a third of all rows: deltas, lags, repair and batches stay whole."""
    n = 3000
    start = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    base = spark.range(n).select(
        F.when(F.col("id") < n // 3, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("_keyhash"),
        F.md5(F.col("id").cast("string")).alias("_rowhash"),
        (start + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("_valid_from"),
        F.lit(datetime(2099, 12, 31)).cast("timestamp_ntz").alias("_valid_until"), F.lit(True).alias("_valid_flag"), F.col("id").cast("double").alias("match_quality"))
    assert scd.hash_delta(base, base.where("match_quality >= 10")).count() == 10
    lagged = scd.quality_deltas(base)
    assert lagged.count() == n and lagged.where("_keyhash = 'hot' and quality_delta = 1").count() == n // 3 - 1
    repaired = scd.repair_duplicates(base)
    assert repaired.count() == n and scd.current(repaired).where("_keyhash = 'hot'").count() == 1
    batches = tables.event_batches(base.select("_keyhash", "_rowhash"), ["_keyhash"], ["_rowhash"], 100, unique=True)
    hot = batches.where("_keyhash = 'hot'")
    assert rows(hot.agg(F.sum("n_records"), F.max("n_records"), F.count(F.lit(1)))) == [(1000, 100, 10)]


def test_checkpoints_go_to_the_folder_the_session_names(spark):
    from tidemark.session import checkpointed

    named = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    files = checkpointed(spark.range(3)).inputFiles()
    assert files and all(named in f for f in files)
    untyped = spark.range(3).withColumn("hole", F.lit(None))
    assert checkpointed(untyped).count() == 3


def test_latest_price_meets_each_line_once(spark):
    """Lines are joined with one row per price key, and are neither grouped nor joined back."""
    day = lambda d: date(2024, 1, d)
    lines = spark.createDataFrame(
        [(1, "p", day(5)), (2, "p", day(15)), (3, "p", day(25)), (4, None, day(5)), (5, "q", day(5)), (6, "p", None)],
        "i int, k string, at date")
    prices = spark.createDataFrame(
        [("p", day(1), day(20), 1.0), ("p", day(10), day(30), 2.0), ("p", day(10), day(30), None), ("q", day(9), day(1), 3.0),
         (None, day(1), day(30), 4.0), ("p", day(1), None, 5.0)], "k2 string, a date, b date, price double")
    found = joins.price_lookup(lines, prices, [("k", "k2")], "at", "a", "b", {"price": "found"}, "latest_start", ["i"])
    assert rows(found, "i", "found") == [(1, 1.0), (2, 2.0), (3, 2.0), (4, None), (5, None), (6, None)]
    assert len(re.findall(r"\w+Join ", plan_of(found).split("Initial Plan")[0])) == 1


def test_a_merge_judges_once_and_leaves_rows_out_of_scope_unshuffled(spark):
    """The closed rows are read from what was judged; rows out of scope pass by a broadcast of the scopes."""
    far, start = datetime(2099, 12, 31), datetime(2024, 1, 1)
    active = spark.createDataFrame(
        [("k1", "r1", start, far, True, "DE", "A"), ("k2", "r2", start, far, True, "DE", "A"),
         ("k3", "r3", start, far, True, "FR", "A"), ("k4", "r4", start, far, True, None, "A"), ("k4", "r4", start, far, True, None, "A")],
        HASHED + ", iso_code string, original_request string")
    staging = spark.createDataFrame(
        [("k1", "r1", "DE", "A"), ("k2", "new", "DE", "A"), ("k5", "r5", None, "A")],
        "_keyhash string, _rowhash string, iso_code string, original_request string")
    closed, kept = scd.scd2_changes(active, staging, datetime(2024, 5, 1, 10, 30))
    assert "Join" not in plan_of(closed)
    assert rows(closed, "_keyhash", "_rowhash", "_valid_flag") == [("k2", "r2", False)]
    assert rows(kept.where("_valid_flag"), "_keyhash", "_rowhash") == [
        ("k1", "r1"), ("k2", "new"), ("k3", "r3"), ("k4", "r4"), ("k4", "r4"), ("k5", "r5")]
    merged = scd.scd2_merge(active, staging, datetime(2024, 5, 1, 10, 30))
    assert rows(merged, "_keyhash", "_rowhash", "_valid_flag") == rows(
        closed.unionByName(kept), "_keyhash", "_rowhash", "_valid_flag")
