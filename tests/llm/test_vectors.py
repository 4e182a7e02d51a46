"""Vector searches against all pairs, with every awkward row."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import adaptive, impact

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("dim", T.StringType()),
        T.StructField("list", T.StringType()),
    ]
)


def vectors(n=600, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    made = (centres[rng.integers(0, 12, n)] + 0.5 * rng.standard_normal((n, dim))).astype(np.float32)
    made /= np.linalg.norm(made, axis=1)[:, None]
    made[100:280] = made[100]  # a third of all rows are one vector
    rows = [(int(k), [float(x) for x in v]) for k, v in enumerate(made)]
    rows += [(1000, None), (1001, []), (1002, [None] * dim), (1003, [math.nan] * dim), (1050, [math.inf] * dim)]
    rows += [(1100, [0.0] * dim), (None, rows[3][1]), rows[4], rows[4], (1150, [1.0, 2.0]), (1151, [2.0, 1.0])]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in vectors()], SCHEMA).cache()


def usable(zero):
    good = {}
    for k, v in vectors():
        if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v)):
            good[k] = np.array(v, np.float64)
    return good


def by_query(got):
    out = {}
    for r in got.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {k: sorted(v) for k, v in out.items()}


def test_exact_top(spark, table):
    good = {k: np.floor(256 * v).astype(np.int64) for k, v in usable(True).items()}
    got = by_query(impact.exact_top(table))
    want = {}
    for q, a in good.items():
        if q % 50 == 0:
            scores = sorted((-int(a @ b), k) for k, b in good.items() if k != q and len(b) == len(a))
            want[q] = [(r + 1, k, -s) for r, (s, k) in enumerate(scores[:5])]
    assert got == want and 1100 in got and len(got[1150]) == 1
    assert impact.exact_top(table.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_index_stops_only_on_proof(seed):
    rng = np.random.default_rng(seed)
    data = np.floor(rng.standard_normal((900, 16)) * rng.choice([3, 300])).astype(float)
    ids = rng.permutation(900)
    for q_id in range(5):
        q = np.floor(rng.standard_normal(16) * 50) * (rng.random(16) < 0.7)
        found, scores = impact.top(q_id, q, ids, data, {}, 5)
        exact = sorted((-int(s), int(k)) for s, k in zip(data @ q, ids, strict=True) if k != q_id)[:5]
        assert list(zip((-scores).tolist(), found.tolist(), strict=True)) == exact


def test_nearest(spark, table):
    good, hit, asked = usable(False), 0, 0
    got = by_query(adaptive.nearest(table))
    for q, a in good.items():
        if q % 50:
            continue
        cosine = {k: float(a @ b) / math.sqrt(float(a @ a) * float(b @ b)) for k, b in good.items() if k != q and len(b) == len(a)}
        found = got[q]
        assert [r for r, *_ in found] == list(range(1, min(5, len(cosine)) + 1))
        assert all(s == pytest.approx(cosine[k], abs=1e-12) for _, k, s in found)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        best = sorted(cosine.values(), reverse=True)[: len(found)]
        hit += sum(s >= best[-1] - 1e-9 for *_, s in found)
        asked += len(found)
    assert set(got) == {q for q in good if q % 50 == 0} and hit >= 0.9 * asked
    assert adaptive.nearest(table.limit(0)).count() == 0
    # copies of the query's vector: the smallest ids come first
    assert [k for _, k, _ in got[150]] == [100, 101, 102, 103, 104]


def test_scan_abandons_most_candidates():
    rng = random.Random(1)
    data = np.array([[rng.gauss(0, 1) for _ in range(64)] for _ in range(2000)])
    lists = adaptive.Lists(data[:500], 1, 5, 3)
    target, lost = data[7] + 0.3 * data[8], 0
    found, scores = adaptive.scan(-1, target, np.arange(2000), data, {}, lists, 5)
    cosine = data @ target / np.linalg.norm(data, axis=1) / np.linalg.norm(target)
    lost = len(set(np.argsort(-cosine)[:5].tolist()) - set(found.tolist()))
    assert lost <= 1 and scores[0] == pytest.approx(cosine.max())


@pytest.mark.parametrize("size", [100, 1 << 25])
def test_impact_search_keeps_no_matrix_of_taken_postings(monkeypatch, size):
    """What is still to come of a row follows from how many of its postings were taken; ties and signs included."""
    shapes, zeros = [], np.zeros
    monkeypatch.setattr(impact.np, "zeros", lambda shape, *a, **k: shapes.append(shape) or zeros(shape, *a, **k))
    rng = np.random.default_rng(3)
    data = rng.integers(-size, size + 1, (700, 24)).astype(float)
    data[50:60], ids, state = data[50], np.arange(700), {}
    for q_id in range(0, 700, 50):
        found, scores = impact.top(q_id, data[q_id], ids, data, state, 5)
        exact = data.astype(np.int64) @ data[q_id].astype(np.int64)
        want = [i for i in np.lexsort((ids, -exact)) if i != q_id][:5]
        assert found.tolist() == want and scores.tolist() == exact[want].tolist()
    assert all(np.ndim(s) == 0 for s in shapes)
