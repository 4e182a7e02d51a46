"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Components are whole numbers, the impacts. In a block of vectors each dimension has postings
ordered by impact. A query takes segments of postings by descending contribution, from all
dimensions at once, and adds them up. What is still to come is bounded by the next segment, so
every vector has an upper bound; it stops when the vectors whose bound reaches the k-th best
exact score are few, and scores those exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import blocks, ranked, searched, usable

BLOCK, QUERY_BLOCK = 4096, 256
LEVELS = (0.6, 0.4, 0.25, 0.15, 0.08)
#: Sizes up to this keep every inner product of 8,192 dimensions within 64 bits.
MOST_IMPACT = 1 << 25


class Postings:
    """A block's impacts, and for every dimension its rows by descending impact."""

    def __init__(self, data: np.ndarray):
        self.impacts = data.astype(np.int64)
        columns = np.ascontiguousarray(self.impacts.T)
        self.order = np.argsort(columns, axis=1, kind="stable")
        self.rising = np.take_along_axis(columns, self.order, axis=1)
        self.largest = np.abs(self.rising[:, [0, -1]]).max(axis=1).astype(float)

    def segment(self, d: int, weight: int, least: float, begun: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and impacts not yet taken of dimension ``d`` that contribute at least ``least``."""
        rising, n = self.rising[d], self.rising.shape[1]
        if weight > 0:
            end = max(begun, n - int(np.searchsorted(rising, int(np.ceil(least / weight)), "left")))
            part = slice(n - end, n - begun)
        else:
            end = max(begun, int(np.searchsorted(rising, int(np.floor(least / weight)), "right")))
            part = slice(begun, end)
        return self.order[d, part], rising[part], end


def top(q_id: int, q: np.ndarray, ids: np.ndarray, data: np.ndarray, state: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of a block but for the query's own row: (ids, scores)."""
    index = state.get("postings")
    if index is None:
        index = state["postings"] = Postings(data)
    weights = q.astype(np.int64)
    n, dims = index.impacts.shape
    other = ids != q_id
    if other.sum() <= 4 * k:
        return _best(np.flatnonzero(other), index, weights, ids, k)
    used = np.flatnonzero(weights)
    most = np.maximum(weights * index.rising[:, 0], weights * index.rising[:, -1])
    peak = int(most.max(initial=0))
    total, taken = np.zeros(n, np.int64), np.zeros(n)  # of a row: sum and number of its postings taken
    small = np.abs(weights).astype(float) @ index.largest < 1 << 53  # sums are exact as doubles
    begun = np.zeros(dims, np.int64)
    cut = None
    for level in LEVELS if peak > 0 else ():
        least = level * peak
        segments = []
        for d in used[most[used] >= least].tolist():
            rows, impacts, begun[d] = index.segment(d, int(weights[d]), least, int(begun[d]))
            segments.append((rows, weights[d] * impacts))
        rows, added = (np.concatenate(part) for part in zip(*segments))
        taken += np.bincount(rows, minlength=n)
        if small:
            total += np.bincount(rows, added, n).astype(np.int64)
        else:
            np.add.at(total, rows, added)
        # No posting still to come adds more than its dimension's most or the level; a dimension
        # with postings taken has a larger most, so each of them leaves the level out of the bound.
        rest = np.minimum(most, np.floor(least))
        bound = total + rest.sum() - np.floor(least) * taken
        sample = np.argpartition(-np.where(other, total, total.min() - 1), 4 * k)[: 4 * k]
        exact = np.sort(index.impacts[sample[other[sample]]] @ weights)[::-1]
        if len(exact) >= k:
            cut = int(exact[k - 1]) if cut is None else max(cut, int(exact[k - 1]))
        if cut is not None:
            members = np.flatnonzero(other & (bound >= cut))
            if len(members) <= max(16 * k, n // 16):
                return _best(members, index, weights, ids, k)
    return _best(np.flatnonzero(other if cut is None else other & (bound >= cut)), index, weights, ids, k)


def _best(rows: np.ndarray, index: Postings, weights: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    scores = index.impacts[rows] @ weights
    best = np.lexsort((ids[rows], -scores))[:k]
    return ids[rows[best]], scores[best]


def exact_top(table: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` largest integer inner products.

    ``table`` has vec_id and embedding; other columns are left out. A component x becomes
    ``floor(scale * x)``. Queries are the rows whose vec_id is divisible by ``every``, and each
    is compared with all rows of as many dimensions but its own. Ties go to the smaller vec_id.

    Rows with a null vec_id, and vectors that are null, empty, hold a null or a value that is
    not finite take no part, nor do components beyond ``MOST_IMPACT`` in size, whose products
    no longer fit. Rows that share a vec_id count as one (the smallest vector). An empty table
    gives an empty table.
    """
    whole = usable(table, zero=True, most=MOST_IMPACT / scale).select(
        "vec_id", "dim", F.transform("vector", lambda x: F.floor(x * scale).cast("double")).alias("vector")
    )
    held = blocks(whole, ["dim"], BLOCK, "c")
    numbered = held.withColumn("_n", F.expr("pmod(xxhash64(c_ids), 4096)"))
    asked = blocks(whole.where(F.col("vec_id") % every == 0), ["dim"], QUERY_BLOCK, "q")
    # each block of queries goes to every group of blocks of its dimension
    groups = numbered.select("dim", "_n").distinct().select(F.col("dim").alias("_dim"), F.col("_n").alias("_to"))
    sent = asked.join(groups, F.col("dim") == F.col("_dim")).select("_dim", "_to", "q_ids", "q_data")
    pairs = numbered.join(sent, (F.col("dim") == F.col("_dim")) & (F.col("_n") == F.col("_to")))

    def search(q_id, q, ids, data, state):
        return top(q_id, q, ids, data, state, k)

    return ranked(searched(pairs.select("c_ids", "c_data", "q_ids", "q_data"), search, "long"), k)
