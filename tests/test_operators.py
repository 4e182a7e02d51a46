"""Joins, selection, ordering, reshaping and measures."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import aggregates, joins, ordering, reshape, select


# --- joins -----------------------------------------------------------------------------------


def test_lookup_takes_one_row_per_key_and_a_default(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 5), ("a", 3), (None, 9)], "name string, id int")
    assert rows(joins.lookup(df, dim, [("k", "name")], "id", "x", default=0)) == [(None, 0), ("a", 3), ("b", 0)]


def test_fallback_lookup_splits_completely(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    one = spark.createDataFrame([("a", 1), ("a", 7)], "k1 string, v int")
    two = spark.createDataFrame([("a", 10), ("b", 20)], "k2 string, v int")
    ok, bad = joins.fallback_lookup(df, "k", [(one, "k1", "v"), (two, "k2", "v")], "id")
    assert rows(ok, "k", "id") == [("a", 1), ("b", 20)]
    assert rows(bad, "k") == [(None,), ("c",)]
    assert "could not resolve k c" in {r["reject_reason"] for r in bad.collect()}


def test_array_lookup_keeps_order_and_counts_unknown(spark):
    df = spark.createDataFrame([(1, ["b", "x", "a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("b", 5)], "n string, v int")
    got = joins.array_lookup(df, ["id"], "xs", dim, "n", "v", "ids", "unknown").select("id", "ids", "unknown")
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, [2, 1, 2], 1), (2, [], 0), (3, [], 0)]


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "i int, k string")
    b = spark.createDataFrame([(None, "n"), ("x", "m")], "k string, v string")
    assert rows(joins.null_safe_join(a, b, ["k"]), "i", "v") == [(1, "n"), (2, "m")]
    assert rows(joins.null_safe_join(a, b, ["k"], "left_anti"), "i") == [(3,)]


def test_full_outer_coalesce(spark):
    a = spark.createDataFrame([(1, "a", 10), (2, None, 20)], "k int, v string, x int")
    b = spark.createDataFrame([(2, "b", 200), (3, "c", 300)], "k int, v string, y int")
    got = joins.full_outer_coalesce(a, b, ["k"], ["v"]).select("k", "v", "x", "y")
    assert [tuple(r) for r in got.orderBy("k").collect()] == [(1, "a", 10, None), (2, "b", 20, 200), (3, "c", None, 300)]


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(
        [("p", date(2024, 1, 1), date(2024, 1, 31), 1.0), ("p", date(2024, 1, 31), date(2024, 2, 29), 2.0), ("q", date(2024, 1, 1), date(2024, 1, 1), 9.0)],
        "code string, a date, b date, price double")


def test_price_lookup_includes_both_ends_and_keeps_overlaps(spark, prices):
    lines = spark.createDataFrame(
        [(1, "p", date(2024, 1, 1)), (2, "p", date(2024, 1, 31)), (3, "p", date(2024, 3, 1)), (4, None, date(2024, 1, 1))], "i int, c string, at date")
    args = (prices, [("c", "code")], "at", "a", "b", {"price": "price"})
    assert rows(joins.price_lookup(lines, *args), "i", "price") == [(1, 1.0), (2, 1.0), (2, 2.0), (3, None), (4, None)]
    latest = joins.price_lookup(lines, *args, pick="latest_start", line_id=["i"])
    assert rows(latest, "i", "price") == [(1, 1.0), (2, 2.0), (3, None), (4, None)]


def test_unseen_drops_null_names_always(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "n string")
    seen = spark.createDataFrame([("a",), (None,)], "n string")
    assert rows(joins.unseen(df, seen, "n")) == [("b",)]
    assert rows(joins.unseen(df, seen.limit(0), "n")) == [("a",), ("b",)]


def test_skip_loaded_takes_the_first_copy(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), ("c", 1, "w")], "k string, t int, v string")
    loaded = spark.createDataFrame([("b",)], "k string")
    assert rows(joins.skip_loaded(df, loaded, "k", ["t"])) == [("a", 1, "y"), ("c", 1, "w")]


def test_restrict_dim_with_suffix(spark):
    dim = spark.createDataFrame([("1",), ("2-contact",), ("3",), ("4",)], "uuid string")
    batch = spark.createDataFrame([(1, "2", None)], "a int, b string, c string")
    assert rows(joins.restrict_dim(dim, "uuid", batch, ["a", "b", "c"], ["-contact"])) == [("1",), ("2-contact",)]


def test_propagate_active_reaches_all_rows_of_the_group(spark):
    df = spark.createDataFrame(
        [("m1", "e1", 0), ("m1", "e2", 0), ("m2", "e2", 1), ("m3", "e3", 0), ("m4", None, 1), ("m5", None, 0)], "m string, e string, act int")
    got = joins.propagate_active(df, ["m"], ["e"], F.col("act") == 1, "x")
    # m1 shares e2 with an active row; null members count as one value.
    assert {(r["m"], r["x"]) for r in got.collect()} == {("m1", True), ("m2", True), ("m3", False), ("m4", True), ("m5", True)}


# --- one row per key -------------------------------------------------------------------------


def test_best_per_key_ranks_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("k", None, 1, "a"), ("k", 5, 2, "c"), ("k", 5, 2, "b"), ("j", None, 1, "z"), (None, 1, 1, "n")], "k string, score int, t int, v string")
    assert rows(select.best_per_key(df, ["k"], ["-score", "t"]), "k", "v") == [(None, "n"), ("j", "z"), ("k", "b")]


def test_best_per_key_ranks_timestamps_downwards(spark):
    df = spark.createDataFrame([("k", datetime(2024, 1, 1)), ("k", datetime(2024, 1, 2))], "k string, t timestamp_ntz")
    assert select.best_per_key(df, ["k"], ["-t"]).first()["t"] == datetime(2024, 1, 2)


# --- order -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 500, 501, 1203])
def test_chunks_cover_every_row_once(spark, n):
    got = ordering.chunk_by_rank(spark.range(n), ["id"], 500, unique=True)
    sizes = {r["chunk"]: r["count"] for r in got.groupBy("chunk").count().collect()}
    assert sum(sizes.values()) == n
    assert sorted(sizes) == list(range((n + 499) // 500))
    assert all(sizes[c] == 500 for c in sizes if c < len(sizes) - 1)


def test_global_rank_equals_sorted_position(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = ordering.global_rank(df, [F.col("v").desc()], "rnk", unique=True)
    assert all(r["rnk"] == 1000 - r["v"] for r in got.collect())


def test_rank_of_identical_rows_is_complete(spark):
    df = spark.range(30_000).select(F.lit("same").alias("v")).unionAll(spark.createDataFrame([("other",)], "v string"))
    got = ordering.global_rank(df, ["v"], "rnk")
    assert got.count() == 30_001
    stats = got.agg(F.min("rnk"), F.max("rnk"), F.count_distinct("rnk")).first()
    assert tuple(stats) == (1, 30_001, 30_001)
    assert got.where("v = 'other'").first()["rnk"] == 1


def test_copies_are_spread_over_partitions(spark):
    df = spark.range(40_000).select(F.lit("same").alias("v"))
    placed = ordering.range_ordered(df, ["v"])
    sizes = [r["count"] for r in placed.groupBy("_range_part").count().collect()]
    assert sum(sizes) == 40_000 and len(sizes) == 4 and max(sizes) < 20_000


def test_rank_slice(spark):
    got = ordering.rank_slice(spark.range(100), ["id"], 11, 20, unique=True)
    assert sorted(r["id"] for r in got.collect()) == list(range(10, 20))


@pytest.mark.parametrize("n", [3, 10, 23])
def test_ntile_equals_the_window_function(spark, n):
    from pyspark.sql import Window

    df = spark.range(n)
    ours = ordering.ntile_batch(df, ["id"], 10, unique=True)
    theirs = df.withColumn("tile", F.ntile(10).over(Window.partitionBy(F.lit(1)).orderBy("id")))
    assert rows(ours, "id", "tile") == rows(theirs, "id", "tile")


def test_lag_in_key_crosses_partitions(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"), "id")
    df = df.unionAll(spark.createDataFrame([(None, 1), (None, 5)], "k string, id bigint"))
    from pyspark.sql import Window

    got = ordering.lag_in_key(df, ["k"], ["id"], "id", "prev", unique=True)
    want = df.withColumn("prev", F.lag("id").over(Window.partitionBy("k").orderBy("id")))
    assert rows(got, "k", "id", "prev") == rows(want, "k", "id", "prev")


# --- reshape -------------------------------------------------------------------------------------


def test_unpivot_flags_uses_each_flags_own_dates(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 1, 1, at), (2, 0, None, at), (3, None, 1, None)], "id int, f int, g int, f_from timestamp_ntz")
    flags = [reshape.Flag("f", "F", 100, "f_from", "missing"), reshape.Flag("g", "G", 101)]
    got = reshape.unpivot_flags(df, flags, ["id"])
    assert rows(got, "id", "service_cd", "date_from", "date_to") == [(1, 100, at, None), (1, 101, None, None), (3, 101, None, None)]


def test_union_positional_takes_names(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2, "y")], "c int, d string")
    assert rows(reshape.union_positional(a, b, ["n", "s"])) == [(1, "x"), (2, "y")]


def test_nested_lines_are_ordered_and_paged(spark):
    df = spark.range(1200).select(F.lit("hot").alias("k"), "id").unionAll(spark.createDataFrame([("small", 2), ("small", 1)], "k string, id bigint"))
    got = reshape.nest_lines(df, ["k"], ["id"], ["id"], page_size=500)
    sizes = {(r["k"], r["page_no"]): [x["id"] for x in r["lines"]] for r in got.collect()}
    assert sizes[("small", 0)] == [1, 2]
    assert sizes[("hot", 0)] == list(range(500)) and len(sizes[("hot", 2)]) == 200 and len(sizes) == 4


def test_nested_lines_are_one_row_a_key_at_any_size(spark):
    df = spark.range(1501).select(F.when(F.col("id") < 1500, "hot").otherwise("small").alias("k"), (F.col("id") % 3).alias("o"), "id")
    got = {r["k"]: [x["id"] for x in r["lines"]] for r in reshape.nest_lines(df, ["k"], ["o"], ["id"]).collect()}
    assert got["small"] == [1500] and got["hot"] == sorted(range(1500), key=lambda i: (i % 3, i))
    with pytest.raises(ValueError, match="hot"):
        reshape.nest_lines(df, ["k"], ["o"], ["id"], max_lines=1000)


# --- measures --------------------------------------------------------------------------------------


def test_money_sum_is_exact_and_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (-0.305,), (None,)], "v double").select(aggregates.units("v").alias("u"))
    got = df.agg(aggregates.money_sum("u").alias("s"), aggregates.money_sum("u", "false").alias("n"), aggregates.money_sum("u", "false", True).alias("z")).first()
    assert (float(got["s"]), got["n"], float(got["z"])) == (-0.01, None, 0.0)


def test_week_lags_find_the_week_before_week_one(spark):
    sales = spark.createDataFrame([("p", datetime(2023, 12, 31, 23), 3), ("p", datetime(2023, 12, 24), 4), ("p", datetime(2024, 1, 2), 9)], "p string, t timestamp_ntz, n int")
    got = aggregates.week_lags(sales, ["p"], "t", "n", date(2024, 1, 3), {1: "one", 2: "two"})
    assert rows(got) == [("p", 3, 4)]


def test_outcome_summary_and_error_rate(spark):
    done = spark.createDataFrame([("success",), ("failed",), (None,)], "o string")
    skipped = spark.createDataFrame([("x",)], "id string")
    assert tuple(aggregates.outcome_summary(done, "o", skipped).first()) == (3, 1, 2, 1)
    assert tuple(aggregates.outcome_summary(done, "o").first()) == (3, 1, 2, 0)
    chunked = spark.createDataFrame([(0, True), (0, False), (1, False)], "c int, bad boolean")
    progress = aggregates.chunk_progress(chunked, "c", F.col("bad"))
    assert rows(progress) == [(0, 1, 1), (1, 1, 0)]
    assert tuple(aggregates.error_rate(progress).first()) == (2, 1, 0.5, True)
    assert aggregates.error_rate(progress.limit(0)).first()["error_rate"] is None
