"""Matching against a brute-force comparison of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import matching

SCHEMA = "id string, iso_code string, name string, zip string, city string, street string, email string, phone string, website string, legal_id string"


def random_side(spark, seed, n):
    rng = random.Random(seed)
    words = ["cafe", "roma", "bar", "pizza", "joe", "joes", "gmbh", "sushi", "grill", "haus"]
    data = []
    for i in range(n):
        pick = lambda options: rng.choice(options)
        data.append((
            f"{seed}-{i}", pick(["DE", "de", "FR"]), pick([" ".join(rng.sample(words, rng.randrange(1, 5))), None, "Solo"]),
            pick(["10115", "10 115", "20095", None]), pick(["Berlin", "Bern", None]), pick(["Main St. 12", "Main Str 12a", "Side Road 3-5", "Side", None]),
            pick(["a@x.de", "b@x.de", "c@y.de", None, None]), pick(["+49 30 1", "0049301", "5", None, None]),
            pick(["https://www.x.de/a", "x.de", None, None]), pick(["DE 1", "de1", "DE2", None, None])))
    return spark.createDataFrame(data, SCHEMA)


def brute_force(a, b, weights, threshold):
    left, right = matching.profiles(a), matching.profiles(b)
    wide = left.select(*[F.col(c).alias(f"a_{c}") for c in left.columns]).join(
        right.select(*[F.col(c).alias(f"b_{c}") for c in right.columns]), F.col("a_iso_code") == F.col("b_iso_code"))
    scored = matching.field_scores(wide)
    total = F.round(
        F.col("fm_mean_name") * weights["name"] + F.col("fm_mean_address") * weights["address"]
        + F.col("fm_max_contact") * weights["contact"] + F.col("fm_mean_legal_id") * weights["legal"], 6)
    return scored.withColumn("q", total).where(F.col("q") >= threshold).select(F.col("a_id"), F.col("b_id"), "q")


@pytest.mark.parametrize("weights,threshold", [
    (matching.WEIGHTS, 0.60), (matching.WEIGHTS, 0.75),
    ({"name": 0.5, "address": 0.2, "contact": 0.2, "legal": 0.1}, 0.65),
])
def test_no_result_is_lost_against_all_pairs(spark, weights, threshold):
    a, b = random_side(spark, 1, 150), random_side(spark, 2, 120)
    want = rows(brute_force(a, b, weights, threshold))
    got = rows(matching.match_establishments(a, b, weights, threshold).select("id_source_1", "id_source_2", "match_quality"))
    assert got == want and len(want) > 20


def test_weights_that_candidates_cannot_cover_are_refused(spark):
    side = random_side(spark, 1, 2)
    with pytest.raises(ValueError):  # no equal field and a name score of 0.5 would do
        matching.match_establishments(side, side, {"name": 0.8, "address": 0.1, "contact": 0.05, "legal": 0.05}, 0.45)
    assert matching.least_names(matching.WEIGHTS, 0.5)[frozenset()] == pytest.approx(0.875, abs=1e-4)


def test_names_match_by_spelling_sound_and_abbreviation(spark):
    left = [("1", "DE", "Bellavista", "10115", "Berlin", "Main St 12", "info@bella.de", "+49 30 1", None, None),
            ("2", "DE", "Meier Bau GmbH", "20095", "Hamburg", "Elbweg 3", None, None, None, None),
            ("3", "DE", "Acme Intl", "80331", "Munich", "Hof 7", None, None, None, None),
            ("4", "DE", "Roma", "10115", "Berlin", "Main St 12", "x@gmail.com", None, None, None)]
    right = [("a", "DE", "Bella Vista", "10115", "Berlin", "Main Str. 12", "office@bella.de", "0049301", None, None),
             ("b", "DE", "Meyer Bau", "20095", "Hamburg", "Elbweg 3", None, None, None, None),
             ("c", "DE", "ACME International", "80331", "Munich", "Hof 7", None, None, None, None),
             ("d", "DE", "Sushi Bar", "10115", "Berlin", "Main St 12", "y@gmail.com", None, None, None)]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = {(r.id_source_1, r.id_source_2): r for r in matching.match_establishments(a, b).collect()}
    assert set(got) == {("1", "a"), ("2", "b"), ("3", "c")}
    assert got[("1", "a")].fm_edit == 1.0 and got[("1", "a")].fm_mean_address == 1.0 and got[("1", "a")].fm_max_contact == 1.0
    assert got[("2", "b")].fm_phonetic == 1.0 and got[("3", "c")].fm_words == 1.0
    assert rows(matching.match_establishments(a, b).select("id_source_1", "id_source_2", "match_quality")) == rows(
        brute_force(a, b, matching.WEIGHTS, matching.THRESHOLD))


@pytest.mark.parametrize("word", ["Restaurant ", ""])
def test_a_shared_mail_host_and_city_keep_every_result(spark, word):
    """300 and 600 places share gmail.com and Berlin, with or without a common word in their names.

    Without the word few pairs are candidates. With it, every name starts with "restaur", a
    segment that the edit filter cannot tell apart, and all pairs are candidates (README).
    """
    def side(n, shift):
        return spark.range(n).select(
            F.concat(F.lit("r"), (F.col("id") + shift).cast("string")).alias("id"), F.lit("DE").alias("iso_code"),
            F.concat(F.lit(word), F.conv((F.col("id") * 7919 + 104729).cast("string"), 10, 36)).alias("name"),
            (F.col("id") % 97 + 10000).cast("string").alias("zip"), F.lit("Berlin").alias("city"),
            F.concat(F.lit("Weg "), (F.col("id") % 13).cast("string")).alias("street"),
            F.concat(F.lit("r"), F.col("id").cast("string"), F.lit("@gmail.com")).alias("email"),
            *[F.lit(None).cast("string").alias(c) for c in ("phone", "website", "legal_id")])
    a, b = side(300, 0), side(600, 1000)
    pairs = matching.candidate_pairs(matching.profiles(a), matching.profiles(b)).count()
    print(f"candidates with {word!r}: {pairs} of {300 * 600}")
    assert word or pairs < 300 * 600 / 20
    got = rows(matching.match_establishments(a, b).select("id_source_1", "id_source_2", "match_quality"))
    assert got == rows(brute_force(a, b, matching.WEIGHTS, matching.THRESHOLD))


def test_record_pairs_carry_the_merge_hashes(spark):
    one = ("Joe's Pizza GmbH", "10115", "Berlin", "Main St 12", "a@joes.de", None, None, "DE1")
    a = spark.createDataFrame([(f"a{i}", "DE", *one) for i in range(3)], SCHEMA)
    b = spark.createDataFrame([(f"b{i}", "de", *one) for i in range(2)], SCHEMA)
    records = matching.match_records(matching.match_establishments(a, b), a, b, "run-1", "crm", "erp").collect()
    assert len(records) == 6
    first = [r for r in records if (r.id_source_1, r.id_source_2) == ("a0", "b1")][0]
    import hashlib
    assert first["_keyhash"] == hashlib.md5(b"crm|a0|erp|b1").hexdigest()
    assert len({r["_rowhash"] for r in records}) == 1 and first.run_id == "run-1"


def test_copies_are_matched_once_and_can_be_expanded(spark):
    one = ("Joe's Pizza GmbH", "10115", "Berlin", "Main St 12", "a@joes.de", None, None, "DE1")
    a = spark.createDataFrame([(f"a{i}", "DE", *one) for i in range(300)], SCHEMA)
    b = spark.createDataFrame([(f"b{i}", "de", *one) for i in range(200)], SCHEMA)
    got = matching.match_establishments(a, b).collect()
    assert len(got) == 1
    assert (got[0]["n_id_source_1_matches"], got[0]["n_id_source_2_matches"], got[0]["match_quality"]) == (300, 200, 1.0)
    assert got[0]["fm_phonetic"] == 1.0
    assert matching.members(a).where(F.col("profile_id") == got[0]["profile_a"]).count() == 300


def test_candidates_stay_far_below_all_pairs_of_a_hot_block(spark):
    """A third of all rows share zip and street; names that share no word do not become pairs."""
    def side(shift):
        return spark.range(600).select(
            F.concat(F.lit("x"), F.col("id").cast("string")).alias("id"), F.lit("DE").alias("iso_code"),
            F.conv(((F.col("id") + shift) * 7919 + 104729).cast("string"), 10, 36).alias("name"),
            F.lit("10115").alias("zip"), F.lit("Berlin").alias("city"), F.lit("Main 1").alias("street"),
            *[F.lit(None).cast("string").alias(c) for c in ("email", "phone", "website", "legal_id")])
    hot, shifted = side(0), side(500)
    pairs = matching.candidate_pairs(matching.profiles(hot), matching.profiles(shifted))
    matched = matching.match_establishments(hot, shifted)
    assert rows(matched.select("id_source_1", "id_source_2", "match_quality")) == rows(
        brute_force(hot, shifted, matching.WEIGHTS, matching.THRESHOLD))
    assert matched.count() >= 100
    assert pairs.count() < 600 * 600 / 20


def test_top_match_per_profile(spark):
    a, b = random_side(spark, 5, 60), random_side(spark, 6, 60)
    matches = matching.match_establishments(a, b)
    top = matching.top_matches(matches)
    assert top.count() == matches.select("profile_a").distinct().count()
    best = matches.groupBy("profile_a").agg(F.max("match_quality").alias("q"))
    assert top.join(best, "profile_a").where("match_quality <> q").count() == 0


def test_candidate_keys_are_never_broadcast_and_stand_in_the_plan_once(spark):
    """Keys are many times their profiles: a broadcast of them, or a plan with a copy per score, fills the driver."""
    from tidemark.session import checkpointed

    a, b = random_side(spark, 7, 80), random_side(spark, 8, 60)
    left, right = checkpointed(matching.profiles(a)), checkpointed(matching.profiles(b))
    pairs = matching.candidate_pairs(left, right)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    keyed_joins = [line for line in plan.splitlines() if "Join" in line and ("block" in line or "name_key" in line)]
    assert keyed_joins and all("SortMergeJoin" in line for line in keyed_joins)
    assert len(pairs._jdf.queryExecution().optimizedPlan().toString()) < 120_000


def test_blocks_compared_whole_and_by_name_keys_give_the_same_results(spark, monkeypatch):
    a, b = random_side(spark, 9, 120), random_side(spark, 10, 100)
    want = rows(brute_force(a, b, matching.WEIGHTS, matching.THRESHOLD))
    for most in (0, 12, 10**6):
        monkeypatch.setattr(matching, "PAIRS_PER_ROW", most)
        assert rows(matching.match_establishments(a, b).select("id_source_1", "id_source_2", "match_quality")) == want
