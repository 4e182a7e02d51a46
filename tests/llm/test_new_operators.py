"""Phrase tiles, token files and the conversation trie against plain versions of their contracts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import trie_brute
from corpus import prose
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import collocations, prefix_trie, token_files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("x", "g", "id", "f", "phrase", "score")]
)


def _phrases(rows, least, longest=5, top=2000):
    """The op11 contract, counted plainly."""
    counts: dict[str, Counter] = {}
    totals: Counter = Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(ws[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = totals[lang]
        cands = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        kept = []
        for p, a in cands.items():
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in cands.items()
            )
            if inside:
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        kept.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(kept[:top])]
    return sorted(out)


def _corpus(seed=3):
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(3, 12)) for _ in range(6)]
    rows = []
    for k in range(120):
        parts = [rng.choice(base) for _ in range(rng.randint(1, 4))]
        text = rng.choice([". ", ", ", "\n", " ", "\t", "; "]).join(parts)
        rows.append((k, text.upper() if k % 17 == 0 else text, rng.choice(["en", "de", None])))
    rows += [(200, None, "en"), (201, "", None), (202, " \t ", "en"), (203, "x" * 3000, "de"), (7, rows[7][1], rows[7][2])]
    rows += [(None, rows[9][1], rows[9][2])]
    return rows


def test_phrase_tiles_against_plain_counts(spark):
    rows = _corpus()
    df = spark.createDataFrame([(i, t, l, *("c",) * 6) for i, t, l in rows], DOCS)
    got = collocations.collocations(df, least=3, top=7, tile=4, chunk=5)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = _phrases([(t, l) for _, t, l in rows], least=3, top=7)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 10


def test_phrase_tiles_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert collocations.collocations(empty, least=2).count() == 0
    blank = spark.createDataFrame([(1, None, None, *("c",) * 6), (2, "a b", "en", *("c",) * 6)], DOCS)
    assert collocations.collocations(blank, least=2).count() == 0


def test_products_beyond_64_bits_stay_exact(spark):
    # a * n * 1000 passes 2**63 only on huge corpora; the SQL is the same for small and large values
    got = spark.range(1).select(
        F.expr("(1000 * cast(4000000000 as decimal(38,0)) * cast(9000000000000 as decimal(38,0))) div "
               "(cast(4000000000 as decimal(38,0)) * cast(5000000000 as decimal(38,0)))").cast("long").alias("s")
    ).first()["s"]
    assert got == 1000 * 4000000000 * 9000000000000 // (4000000000 * 5000000000)


def _token_rows():
    rng = random.Random(5)
    rows = [(k, prose(rng, rng.randint(0, 300))) for k in range(600)]
    rows += [(600, None), (601, ""), (602, "é ünï ✓ 日本\n語 <|endoftext|>"), (603, prose(rng, 20_000)), (5, rows[5][1]), (5, "other")]
    rows += [(None, "no id"), (None, None)]
    return rows


def _token_brute(rows):
    tok = Tokenizer.from_file(TOKENIZER)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, out = 0, []
    for doc_id, text in ordered:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, tmp_path):
    rows = _token_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = token_files.round_trip(df, TOKENIZER).collect()
    assert sorted(got, key=lambda r: r.start) == [tuple(r) for r in _token_brute(rows)]
    assert token_files.round_trip(df.limit(0), TOKENIZER).count() == 0


def test_one_document_is_read_from_its_frame(spark, tmp_path):
    rows = _token_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = str(tmp_path / "shards")
    written = token_files.write_shards(df, folder, TOKENIZER)
    tok = Tokenizer.from_file(TOKENIZER)
    found = []
    for shard in [r.shard for r in written.collect()]:
        found += token_files.read_document(folder, shard, 602)
    assert len(found) == 1
    assert found[0].tolist() == tok.encode(rows[602][1], add_special_tokens=False).ids + [2]
    with open(f"{folder}/{token_files.DICTIONARY}", "rb") as f:
        assert len(f.read()) > 0  # enough ids to learn a dictionary from


def _conversations(seed=11):
    rng = random.Random(seed)
    texts = ["hi", "hello there", "how are you", "fine", "bye", "ok", "é ✓", ""]
    rows = []
    for c in range(60):
        n = rng.choice([0, 1, 2, 3, 5, 8])
        for t in range(n):
            rows.append((c, t if rng.random() > 0.05 else None, rng.choice(["user", "bot", None]), rng.choice(texts + [None])))
    for c in range(100, 160):  # many copies of one conversation
        rows += [(c, 0, "user", "hot start"), (c, 1, "bot", "hot reply")]
    rows += [(200, 3, "user", "x"), (200, 3, "user", "x"), (None, 1, "user", "lost")]  # repeated rows, null id
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 41])
def test_trie_against_all_prefixes(spark, partitions):
    rows = _conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=lambda r: (r[0], r[1]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == trie_brute.trie(rows)


def test_trie_findclose_and_empty(spark):
    bits = np.array([1, 1, 0, 1, 1, 0, 0, 0] + [1, 0] * 100, np.int8)
    bp = prefix_trie.Parentheses(np.concatenate(([1], bits, [0])))
    assert bp.findclose(0) == len(bits) + 1
    assert bp.findclose(2) == 3 and bp.findclose(4) == 7
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(empty).count() == 0


def test_phrase_counts_are_not_shuffled_pair_by_pair(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(2000)}" for _ in range(500)), "en") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    store = spark.sparkContext._jsc.sc().statusStore()

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        executors = store.executorList(False)
        return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))

    df = df.cache()
    df.count()
    before = written()
    assert collocations.collocations(df, least=100, longest=2).count() == 0
    assert written() - before < 8 * 300_000
