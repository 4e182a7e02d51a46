"""The stages one after the other on a small corpus, and each on what it was given."""

import corpus_pipeline
from corpus import corpus, prose, words
from pyspark.sql import functions as F

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def write(spark, folder):
    import random

    rng = random.Random(5)
    once = {i: (i, t, "en", s, None if t is None else len(t)) for i, t, s in corpus() if i is not None and i < 116}
    rows = list(once.values())
    rows += [(1000 + k, x := "WIN! CASH!! " * 20 + prose(rng, 4), "en", "s1", len(x)) for k in range(30)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, *_ in rows if i < 90] + [(i, 0, 0) for i, *_ in rows if i >= 1000]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = write(spark, tmp_path)
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = out
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
    ids = {name: {r[0] for r in df.select("doc_id").collect()} for name, df in kept.items()}
    good = {i for i, t, *_ in rows if i < 90 and words(t)}
    assert len(good - ids["quality"]) <= 2 and not ids["quality"] & set(range(1000, 1030))
    assert ids["line_dedup"] < ids["quality"] and ids["near_dedup"] <= ids["line_dedup"]
    lines = [x.strip().lower() for r in kept["line_dedup"].collect() for x in (r["text"] or "").split("\n") if x.strip()]
    assert len(lines) == len(set(lines))
    assert kept["line_dedup"].where(F.length("text") != F.col("n_chars")).count() == 0
    assert ids["mixing"] == ids["near_dedup"] == ids["packing"]
    assert kept["mixing"].count() == kept["near_dedup"].count()
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(whole.columns) == sorted(kept["packing"].columns)
    assert whole.select("doc_id").distinct().count() == len(ids["packing"])


def test_near_copies_from_80_percent_go(spark, tmp_path):
    plain = [f"w{k}" for k in range(105)]  # 101 shingles
    rows = []
    for base, changed in ((0, (20, 60)), (10, (20, 60, 97))):  # 91 of 111 shingles, then 86 of 116
        for i, at in ((base, ()), (base + 1, changed)):
            text = " ".join(f"x{base}_{k}" if k in at else f"{base}{w}" for k, w in enumerate(plain))
            rows.append((i, text, "en", "s", len(text)))
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, COLUMNS), str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 10, 11]


def test_sequences_follow_the_mixture(spark, tmp_path):
    import random

    rng, rows = random.Random(7), []
    for source, n in (("hot", 420), ("small", 35)):  # bytes about 12 to 1, target shares 12 ** 0.7 to 1
        rows += [(len(rows) + k, prose(rng, rng.randint(200, 1000)), "en", source, 0) for k in range(n)]
    size = {s: sum(len(r[1]) for r in rows if r[3] == s) ** 0.7 for s in ("hot", "small")}
    target = size["small"] / sum(size.values())
    docs = spark.createDataFrame(rows, COLUMNS)
    corpus_pipeline.mixing(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/mixed")
    packed = corpus_pipeline.packing_stage(spark, spark.read.parquet(f"{tmp_path}/mixed"), str(tmp_path))
    got = packed.join(docs.select("doc_id", "source"), "doc_id").collect()
    count = 1 + max(r["sequence_id"] for r in got)
    assert {r["sequence_id"] for r in got} == set(range(count)) and {r["doc_id"] for r in got} == {r[0] for r in rows}

    def share(low, high):
        held = [(r["source"], r["length"]) for r in got if low * count <= r["sequence_id"] < high * count]
        return sum(n for s, n in held if s == "small") / sum(n for _, n in held)

    assert abs(share(0, 0.4) - target) < 0.05
    assert share(0.75, 1) < 0.01 < 0.05 < share(0, 1)  # the small source has run out by then
