"""Sources and sinks on temporary folders."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tidemark.operators import scd
from tidemark.plans.lifecycle import dual_export
from tidemark.sources import tables


def test_replace_append_and_catalog_names(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_replace(spark.range(3), path)
    tables.write_append(spark.range(2), path)
    assert tables.read_table(spark, path).count() == 5
    tables.write_replace(spark.range(1), path)
    assert tables.read_table(spark, path).count() == 1
    tables.write_replace(spark.range(4), "replaced_table")
    assert tables.read_lookup(spark, "replaced_table").count() == 4


def test_replace_with_schema_casts_and_orders(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    tables.write_replace(spark.createDataFrame([(1, 2.6)], "a int, b double"), path, schema)
    got = tables.read_table(spark, path)
    assert got.columns == ["b", "a"] and tuple(got.first()) == (3, "1")


def test_ndjson_round_trip(spark, tmp_path):
    path = str(tmp_path / "j")
    tables.write_ndjson(spark.createDataFrame([(1, ["x"])], "a int, b array<string>"), path)
    assert tuple(tables.read_ndjson(spark, path, "a int, b array<string>").first()) == (1, ["x"])


def test_csv_overwrite_and_bad_values(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "staging")
    source.write_text("id,name\n1,a\n2,b\n")
    for _ in range(2):
        tables.load_csv_overwrite(spark, str(source), "id int, name string", target)
    assert tables.read_table(spark, target).count() == 2
    source.write_text("id,name\nx,a\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|x"):
        tables.read_csv(spark, str(source), "id int, name string").collect()


def test_country_family_skips_missing_members_but_not_all(spark, tmp_path):
    tables.write_replace(spark.range(2), str(tmp_path / "customer_ger"))
    tables.write_replace(spark.range(3), str(tmp_path / "customer_fra"))
    family = {"de": "ger", "fr": "fra", "pl": "pol"}
    got = tables.read_country_family(spark, family, str(tmp_path / "customer_{}"))
    assert {r["country"]: r["count"] for r in got.groupBy("country").count().collect()} == {"DE": 2, "FR": 3}
    with pytest.raises(tables.NoSourceError):
        tables.read_country_family(spark, family, str(tmp_path / "nothing_{}"))


@pytest.mark.parametrize("named", [False, True])
def test_batch_append_is_idempotent_per_day(spark, tmp_path, named):
    path = "batch_history" if named else str(tmp_path / "history")
    for n, day in ((3, 1), (2, 2), (5, 1)):
        tables.append_batch(spark.range(n), path, date(2024, 1, day))
    got = {r["batch_date"]: r["count"] for r in tables.read_table(spark, path).groupBy("batch_date").count().collect()}
    assert got == {date(2024, 1, 1): 5, date(2024, 1, 2): 2}


def test_dual_export_feeds_both_sinks_with_the_same_rows(spark, tmp_path):
    seen = []
    df = spark.createDataFrame([("a", 1), (None, 2)], "uni_key string, v int")
    for _ in range(2):
        dual_export(df, date(2024, 1, 1), str(tmp_path / "h"), [lambda d: seen.append(rows(d))])
    assert seen == [[("a", 1)], [("a", 1)]]
    assert rows(tables.read_table(spark, str(tmp_path / "h")), "uni_key", "v") == [("a", 1)]


def test_raw_landing_keeps_entities_and_days_apart(spark, tmp_path):
    folder = str(tmp_path / "raw")
    for entity, day, n in (("stores", 1, 2), ("stores", 2, 3), ("merchants", 1, 1), ("stores", 1, 4)):
        tables.land_raw(spark.range(n), folder, entity, date(2024, 1, day))
    got = spark.read.json(folder).groupBy("entity", "load_date").count()
    assert {(r["entity"], str(r["load_date"])): r["count"] for r in got.collect()} == {
        ("stores", "2024-01-01"): 4, ("stores", "2024-01-02"): 3, ("merchants", "2024-01-01"): 1}


def test_rejects_have_a_header_and_flat_reasons(spark, tmp_path):
    path = str(tmp_path / "rejects")
    tables.write_rejects(spark.createDataFrame([("x", ["a", "b"])], "id string, reject_reasons array<string>"), path)
    got = spark.read.option("header", True).option("escape", "\\").csv(path).first()
    assert got["id"] == "x" and json.loads(got["reject_reasons"]) == ["a", "b"]


def test_scd_layout_prunes_closed_rows(spark, tmp_path):
    path = str(tmp_path / "scd")
    df = spark.createDataFrame(
        [("k1", "DE", datetime(2024, 1, 1), True), ("k2", "FR", datetime(2024, 1, 2), False)],
        "_keyhash string, iso_code string, _valid_until timestamp_ntz, _valid_flag boolean")
    tables.write_scd(df, path)
    got = tables.read_scd(spark, path)
    assert got.columns == df.columns and rows(got, "_keyhash", "_valid_flag") == [("k1", True), ("k2", False)]
    active = tables.read_scd(spark, path, "active")
    assert active.select(F.input_file_name()).distinct().count() == 1 and rows(active, "_keyhash") == [("k1",)]
    assert tables.read_scd(spark, path, closed_since=date(2024, 1, 3)).count() == 1


CYCLE = "_keyhash string, _rowhash string, iso_code string, _valid_from timestamp_ntz, _valid_until timestamp_ntz, _valid_flag boolean"


def _today(spark, pairs, at):
    return spark.createDataFrame([(k, r, "DE", at, datetime(2099, 12, 31), True) for k, r in pairs], CYCLE)


def _files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet") if "version_state=closed" in str(p)}


@pytest.mark.parametrize("merge", [False, True])
def test_two_cycles_through_storage(spark, tmp_path, merge):
    """write, read, merge, update, twice: as the same cycles in memory, and closed files stay."""
    path, days = tmp_path / "h", [datetime(2024, 1, d, 10) for d in (1, 2, 3)]
    staged = [[("a", "1"), ("b", "1"), ("c", "1")], [("a", "2"), ("b", "1"), ("d", "1")], [("a", "3"), ("d", "1")]]
    memory = _today(spark, staged[0], days[0])
    tables.write_scd(memory, str(path))
    seen = {}
    for pairs, day in zip(staged[1:], days[1:], strict=True):
        today = _today(spark, pairs, day)
        if merge:
            active = tables.read_scd(spark, str(path), "active")
            closed, active = scd.scd2_changes(active, today, day, scope=["iso_code"])
            memory = scd.scd2_merge(memory, today, day, scope=["iso_code"])
        else:
            _, closed, active = scd.delta_changes(today, tables.read_scd(spark, str(path)), day)
            _, memory = scd.delta_cycle(today, memory, day)
        tables.update_scd(closed, active, str(path), day.isoformat())
        now = _files(path)
        assert seen.items() <= now.items()
        seen = now
        assert rows(tables.read_scd(spark, str(path)), *memory.columns) == rows(memory)
    again = tables.read_scd(spark, str(path)).where("not _valid_flag").count()
    assert again == (4 if merge else 2)


@pytest.mark.parametrize("n", [0, 1, 500, 501])
def test_event_batches_hold_at_most_size_rows(spark, n):
    df = spark.range(n).select(F.lit("DE").alias("c"), "id", F.lit(None).cast("string").alias("hole"))
    got = tables.event_batches(df, ["c"], ["id"], 500, unique=True).orderBy("batch_no").collect()
    assert [r["n_records"] for r in got] == ([500] * (n // 500) + ([n % 500] if n % 500 else []))
    ids = [v["value"]["id"] for r in got for v in json.loads(r["body"])["records"]]
    assert ids == list(range(n))
    if n:
        assert json.loads(got[0]["body"])["records"][0] == {"value": {"id": 0, "hole": None}}


def test_event_batches_per_market_and_null_market(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), (None, 4), ("b", 5)], "c string, id int")
    got = tables.event_batches(df, ["c"], ["id"], 2)
    assert {(r["c"], r["batch_no"], r["n_records"]) for r in got.collect()} == {("a", 0, 2), ("a", 1, 1), (None, 0, 1), ("b", 0, 1)}


@pytest.mark.parametrize("step", ["closed", "active", "publish"])
def test_a_run_that_breaks_off_leaves_the_previous_state(spark, tmp_path, monkeypatch, step):
    """A failure before any write step keeps the old state readable; repeating the run then gives the new one."""
    path, days = str(tmp_path / "h"), [datetime(2024, 1, d, 10) for d in (1, 2)]
    first = _today(spark, [("a", "1"), ("b", "1")], days[0])
    tables.write_scd(first, path)
    before = rows(tables.read_scd(spark, path))
    today = _today(spark, [("a", "2"), ("c", "1")], days[1])
    _, want = scd.delta_cycle(today, first, days[1])
    want = rows(want)

    def broken(name):
        if name == step:
            raise RuntimeError(f"broke off before {name}")

    monkeypatch.setattr(tables, "_step", broken)
    _, closed, active = scd.delta_changes(today, tables.read_scd(spark, path), days[1])
    with pytest.raises(RuntimeError):
        tables.update_scd(closed, active, path, "2024-01-02")
    assert rows(tables.read_scd(spark, path)) == before
    assert tables.published(spark, path)[0] == 0
    monkeypatch.setattr(tables, "_step", lambda name: None)
    _, closed, active = scd.delta_changes(today, tables.read_scd(spark, path), days[1])
    tables.update_scd(closed, active, path, "2024-01-02")
    assert rows(tables.read_scd(spark, path)) == want
    assert tables.published(spark, path)[1]["closed"] == ["first", "2024-01-02"]
