"""A small corpus with every awkward case, and plain Python versions of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile("[^\x20\x09-\x0d]+")
SYLLABLES = "ka lo mi nu te ra so vi du pe".split()

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("lang", "source")]
    + [T.StructField("n_chars", T.LongType())]
    # names that operators make or use inside
    + [T.StructField(c, T.StringType()) for c in ("_key", "_run", "_rest", "id", "key", "shard", "score", "spans", "block", "n_kept")]
)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(seed: int = 1) -> list[tuple]:
    """(doc_id, text, source): prose in lines, copies, near copies, nulls, blanks, one long text."""
    rng = random.Random(seed)
    shared = prose(rng, 30)
    texts: list[tuple] = []
    for k in range(60):
        body = "\n".join([prose(rng, rng.randint(8, 40)) for _ in range(rng.randint(1, 4))] + [shared] * (k % 3 == 0))
        texts.append((k, body, f"s{k % 4}"))
    for k in range(60, 90):  # near copies: one or two words changed
        copied = texts[rng.randrange(20)][1].split(" ")
        for _ in range(rng.randint(1, 2)):
            copied[rng.randrange(len(copied))] = "changed"
        texts.append((k, " ".join(copied), "s0"))
    texts += [(k, texts[3][1], "s0") for k in range(90, 110)]
    texts += [(110, None, None), (111, "", "s1"), (112, " \n\t ", None), (113, "one two", "s1"), (114, "One TWO ", "s2")]
    texts += [(None, texts[5][1], "s1"), (None, None, None), (115, "é ünï ✓ 日本\n語 token='abcdef1'", "s3")]
    texts += [(116, prose(rng, 20_000), "s2"), (7, texts[7][1], "s3"), (7, texts[7][1], "s3")]
    return texts


def table(spark, rows=None):
    rows = corpus() if rows is None else rows
    full = [(i, t, "en", s, None if t is None else len(t), *(f"x{c}" for c in range(10))) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


class Sets:
    """Union-find in memory."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
