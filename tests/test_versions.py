"""Versioned tables: the four-run example, deltas, properties, quality checks."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import quality, scd

FAR = datetime(2099, 12, 31)
STAGED = "_keyhash string, _rowhash string, match_quality double, original_request string, iso_code string, _sourcesystem string"
HIST = STAGED + ", _valid_from timestamp_ntz, _valid_until timestamp_ntz, _valid_flag boolean"
PAIR = "_keyhash string, _rowhash string, _valid_from timestamp_ntz, _valid_until timestamp_ntz, _valid_flag boolean"


def staged(spark, *versions, request="r", iso="DE", source="engine"):
    return spark.createDataFrame([(k, r, q, request, iso, source) for k, r, q in versions], STAGED)


def hist_of(spark, *data):
    return spark.createDataFrame(list(data), HIST)


def pairs(spark, *data, start=datetime(2024, 1, 1), end=datetime(2099, 12, 31, 23, 59, 59)):
    full = [(d + (True,))[:3] for d in data]
    return spark.createDataFrame([(k, r, start, end if f else datetime(2023, 12, 31), f) for k, r, f in full], PAIR)


def test_four_runs_of_one_key(spark):
    """The match appears, stays, changes, vanishes; an unrelated key keeps the run in scope."""
    hist = spark.createDataFrame([], HIST)
    other = ("other", "o1", 0.9)
    runs = [
        (datetime(2024, 1, 1, 3), [("abc123", "xyz789", 0.88), other]),
        (datetime(2024, 1, 2, 3), [("abc123", "xyz789", 0.88), other]),
        (datetime(2024, 1, 3, 3), [("abc123", "def456", 0.92), other]),
        (datetime(2024, 1, 4, 3), [other]),
    ]
    seen = []
    for at, matches in runs:
        hist = scd.scd2_merge(hist, staged(spark, *matches), at, source="engine", close="seamless")
        seen.append(rows(hist.where("_keyhash = 'abc123'"), "_rowhash", "match_quality", "_valid_from", "_valid_until", "_valid_flag"))
    first, third, fourth = datetime(2024, 1, 1, 3), datetime(2024, 1, 3, 3), datetime(2024, 1, 4, 3)
    assert seen[0] == seen[1] == [("xyz789", 0.88, first, FAR, True)]
    assert seen[2] == [("def456", 0.92, third, FAR, True), ("xyz789", 0.88, first, third, False)]
    assert seen[3] == [("def456", 0.92, third, fourth, False), ("xyz789", 0.88, first, third, False)]
    # Seamless closing leaves no gap for an as-of read.
    assert scd.as_of_view(hist, third).where("_keyhash = 'abc123'").first()["_rowhash"] == "def456"
    assert scd.as_of_view(hist, third - timedelta(seconds=1)).where("_keyhash = 'abc123'").first()["_rowhash"] == "xyz789"


def test_merge_closes_at_the_hour_by_default(spark):
    hist = hist_of(spark, ("k", "r1", 0.5, "r", "DE", "engine", datetime(2024, 1, 1), FAR, True))
    out = scd.scd2_merge(hist, staged(spark, ("k", "r2", 0.6)), datetime(2024, 1, 3, 3, 25))
    got = {r["_rowhash"]: (r["_valid_from"], r["_valid_until"], r["_valid_flag"]) for r in out.collect()}
    assert got["r1"] == (datetime(2024, 1, 1), datetime(2024, 1, 3, 2, 59, 59), False)
    assert got["r2"] == (datetime(2024, 1, 3, 3), FAR, True)


def test_merge_leaves_other_scopes_and_owners_alone(spark):
    start = datetime(2024, 1, 1)
    hist = hist_of(
        spark,
        ("gone", "g", 0.5, "r", "DE", "engine", start, FAR, True),
        ("france", "f", 0.5, "r", "FR", "engine", start, FAR, True),
        ("request", "q", 0.5, "other", "DE", "engine", start, FAR, True),
        ("manual", "m", 0.5, "r", "DE", "manual", start, FAR, True),
        ("closed", "c", 0.5, "r", "DE", "engine", start, datetime(2024, 1, 2), False),
        ("flagless", "n", 0.5, "r", "DE", "engine", start, FAR, None),
    )
    out = scd.scd2_merge(hist, staged(spark, ("new", "n1", 0.7)), datetime(2024, 2, 1), source="engine")
    flags = {r["_keyhash"]: r["_valid_flag"] for r in out.collect()}
    assert flags == {"gone": False, "france": True, "request": True, "manual": True, "closed": False, "flagless": None, "new": True}
    untouched = ["france", "request", "manual", "closed", "flagless"]
    assert rows(out.where(F.col("_keyhash").isin(untouched))) == rows(hist.where(F.col("_keyhash").isin(untouched)))


def test_merge_makes_the_active_set_equal_to_staging_in_scope(spark):
    import random

    rng = random.Random(3)
    hist = spark.createDataFrame([], HIST)
    at = datetime(2024, 1, 1)
    for _ in range(3):
        at += timedelta(days=1)
        state = {f"k{rng.randrange(30)}": f"r{rng.randrange(4)}" for _ in range(20)}
        stage = staged(spark, *[(k, f"{k}-{r}", 0.5) for k, r in state.items()])
        hist = spark.createDataFrame(scd.scd2_merge(hist, stage, at, source="engine").collect(), HIST)
        assert rows(scd.current(hist), "_keyhash", "_rowhash") == rows(stage, "_keyhash", "_rowhash")
        assert quality.duplicate_keys(hist).count() == 0


def test_merge_cleans_null_texts_on_insert_and_stamps_updates(spark):
    hist = spark.createDataFrame(
        [("k", "r1", "old", "r", "DE", datetime(2024, 1, 1), datetime(2024, 1, 1), FAR, True)],
        "_keyhash string, _rowhash string, name string, original_request string, iso_code string, _update_ts timestamp_ntz, _valid_from timestamp_ntz, _valid_until timestamp_ntz, _valid_flag boolean")
    stage = spark.createDataFrame([("k", "r2", "nan", "r", "DE", datetime(2024, 1, 5))], "_keyhash string, _rowhash string, name string, original_request string, iso_code string, _update_ts timestamp_ntz")
    out = {r["_rowhash"]: r for r in scd.scd2_merge(hist, stage, datetime(2024, 1, 6, 7), clean=["name"]).collect()}
    assert out["r2"]["name"] is None
    assert out["r1"]["_update_ts"] == datetime(2024, 1, 6, 7)


def test_hash_delta_keeps_new_and_changed(spark):
    hist = pairs(spark, ("same", "a"), ("changed", "b"))
    today = pairs(spark, ("same", "a"), ("changed", "b2"), ("new", "n"), ("new", "a"))
    # A new key is sent even when its row hash is known under another key.
    assert rows(scd.hash_delta(today, hist), "_keyhash", "_rowhash") == [("changed", "b2"), ("new", "a"), ("new", "n")]


def test_reverted_value_is_sent_only_when_asked_for(spark):
    hist = pairs(spark, ("k", "a", False), ("k", "b", True))
    today = pairs(spark, ("k", "a"))
    assert scd.hash_delta(today, hist).count() == 0
    assert rows(scd.hash_delta(today, hist, revert_aware=True), "_rowhash") == [("a",)]
    # Literal mode leaves the key without an active row; that is the price of the default.
    _, literal = scd.delta_cycle(today, hist, datetime(2024, 2, 1))
    assert scd.current(literal).count() == 0
    _, aware = scd.delta_cycle(today, hist, datetime(2024, 2, 1), revert_aware=True)
    assert rows(scd.current(aware), "_rowhash") == [("a",)]


def test_expiry_ends_yesterday_and_spares_vanished_keys(spark):
    hist = pairs(spark, ("gone", "g"), ("k", "a"), ("k", "b"), ("old", "x", False))
    out = scd.expire_superseded(hist, pairs(spark, ("k", "b"), ("old", "y")), datetime(2024, 1, 15, 9))
    got = {(r["_keyhash"], r["_rowhash"]): (r["_valid_flag"], r["_valid_until"]) for r in out.collect()}
    assert got[("k", "a")] == (False, datetime(2024, 1, 14, 23, 59, 59))
    assert got[("k", "b")][0] and got[("gone", "g")][0]
    assert got[("old", "x")] == (False, datetime(2023, 12, 31))


def test_second_cycle_on_the_same_snapshot_is_empty(spark):
    hist = pairs(spark, ("k", "a"), ("m", "x"))
    today = pairs(spark, ("k", "b"), ("k", "c"), ("n", "y"))
    delta, after = scd.delta_cycle(today, hist, datetime(2024, 2, 1))
    assert delta.count() == 3
    again, same = scd.delta_cycle(today, after, datetime(2024, 2, 2))
    assert again.count() == 0
    assert rows(same) == rows(after)
    active = scd.current(after)
    assert active.groupBy("_keyhash", "_rowhash").count().where("count > 1").count() == 0


def test_repeated_keys_of_a_snapshot_survive(spark):
    """An account can hold many assets: same key, several rows."""
    today = pairs(spark, ("acc", "a1"), ("acc", "a2"))
    _, hist = scd.delta_cycle(today, pairs(spark, ("acc", "a0")), datetime(2024, 2, 1))
    assert rows(scd.current(hist), "_rowhash") == [("a1",), ("a2",)]


def test_history_reads(spark):
    data = [("k", f"r{i}", datetime(2024, 1, i), datetime(2024, 1, i + 1), i == 3) for i in (3, 1, 2)]
    hist = spark.createDataFrame(data, PAIR)
    assert [r["_rowhash"] for r in scd.history(hist, "k").collect()] == ["r1", "r2", "r3"]
    assert rows(scd.as_of_view(hist, datetime(2024, 1, 2)), "_rowhash") == [("r2",)]
    assert [r["_rowhash"] for r in scd.recently_closed(hist, datetime(2024, 1, 9, 12), 7).collect()] == ["r2"]
    assert scd.closed_count(hist, datetime(2024, 1, 3), 5).first()["deleted_count"] == 2


def test_repair_keeps_the_newest(spark):
    at = [datetime(2024, 1, i) for i in (1, 2, 3)]
    hist = spark.createDataFrame(
        [("k", "a", at[0], FAR, True), ("k", "b", at[1], FAR, True), ("k", "c", at[2], at[2], False), ("j", "d", at[0], FAR, True)], PAIR)
    out = {r["_rowhash"]: (r["_valid_flag"], r["_valid_until"]) for r in scd.repair_duplicates(hist).collect()}
    assert out == {"a": (False, at[0]), "b": (True, FAR), "c": (False, at[2]), "d": (True, FAR)}
    assert quality.duplicate_keys(scd.repair_duplicates(hist)).count() == 0


def test_quality_direction_is_a_parameter(spark):
    hist = spark.createDataFrame([("a", 100.0, True), ("b", 200.0, True), ("c", 900.0, False)], "_keyhash string, match_quality double, _valid_flag boolean")
    got = quality.quality_profile(hist, low=150, min_average=160, max_low_share=0.6, higher_is_better=False).first()
    assert (got["avg_quality"], got["max_quality"], got["low_quality_count"], got["alert"]) == (150.0, 200.0, 1, False)


def test_dq_report_finds_each_fault(spark):
    at = datetime(2024, 6, 1)
    schema = "_keyhash string, match_quality double, src string, _valid_until timestamp_ntz, _valid_flag boolean"
    hist = spark.createDataFrame(
        [("dup", 0.9, "s1", FAR, True), ("dup", 0.9, "s1", FAR, True), ("gap", 0.9, "s1", datetime(2024, 1, 1), False), ("lost", 0.1, "s9", FAR, True)], schema)
    source = spark.createDataFrame([("s1",)], "id string")
    got = {r["check_name"]: (r["value"], r["passed"]) for r in quality.dq_report(hist, hist.limit(2), at, [("src", source, "id")]).collect()}
    assert got["row_count"] == (3.0, False)
    assert got["duplicate_active_keys"] == (1.0, False)
    assert got["history_gaps"] == (1.0, False)
    assert got["orphans_src"] == (1.0, False)
    assert got["low_quality_share"][1] is False and got["average_quality"][1] is False


def test_change_summary(spark):
    hist = pairs(spark, ("same", "a"), ("changed", "b"), ("gone", "c"), ("old", "d", False))
    today = pairs(spark, ("same", "a"), ("changed", "b2"), ("old", "d"))
    got = {r["change"]: r["n"] for r in quality.change_summary(today, hist).collect()}
    assert got == {"unchanged": 1, "changed": 1, "new": 1, "deleted": 1}


@pytest.mark.parametrize("merge", ["cycle", "merge"])
def test_input_order_and_partitions_do_not_matter(spark, merge):
    hist = pairs(spark, *[(f"k{i}", f"r{i}") for i in range(40)])
    today = pairs(spark, *[(f"k{i}", f"r{i % 30}") for i in range(50)])
    run = (lambda t, h: scd.delta_cycle(t, h, datetime(2024, 2, 1))[1]) if merge == "cycle" else (
        lambda t, h: scd.scd2_merge(h.withColumn("iso_code", F.lit("x")), t.select("_keyhash", "_rowhash").withColumn("iso_code", F.lit("x")), datetime(2024, 2, 1), scope=["iso_code"]))
    assert rows(run(today, hist)) == rows(run(today.orderBy(F.rand(1)).repartition(3), hist.orderBy(F.rand(2)).repartition(5)))
