"""Nearest neighbours by cosine with adaptive dimension scan in probed lists.

Vectors lie in lists around centroids; a query probes the lists nearest to it. Unit vectors are
rotated at random, so any leading block of columns is an unbiased sample of a distance. A
list is scanned block of columns by block of columns: a candidate whose partial distance,
scaled up, exceeds the k-th best by more than chance allows is abandoned. Survivors get their
exact cosine on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import blocks, ranked, searched, usable

SAMPLE_ROWS, SAMPLE_VALUES = 20_000, 4_000_000
MOST_LISTS = 1024
BLOCK, QUERY_BLOCK = 2048, 256
COLUMNS = 16
DOUBT = 2.5
AIM = 0.99


class Lists:
    """Rotation, centroids and number of probes, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, rows: int, k: int, seed: int):
        draw = np.random.default_rng(seed)
        n, dim = sample.shape
        self.rotation = np.linalg.qr(draw.standard_normal((dim, dim)))[0]
        unit = self.turned(sample)
        lists = min(MOST_LISTS, max(1, math.isqrt(rows)), n)
        self.centroids = unit[draw.choice(n, lists, replace=False)]
        for _ in range(8):
            near = self.order(unit, 1)[:, 0]
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, near, unit)
            size = np.linalg.norm(sums, axis=1)
            full = size > 0
            self.centroids[full] = sums[full] / size[full, None]
        self.probes = self._probes(unit, draw.choice(n, min(n, 256), replace=False), k)

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        """Unit vectors in the rotated space."""
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)) @ self.rotation

    def order(self, unit: np.ndarray, first: int) -> np.ndarray:
        """The ``first`` nearest lists of each vector, nearest first."""
        out = []
        for at in range(0, len(unit), 1024):
            out.append(np.argsort(-(unit[at : at + 1024] @ self.centroids.T), axis=1, kind="stable")[:, :first])
        return np.concatenate(out) if out else np.zeros((0, first), np.int64)

    def _probes(self, unit: np.ndarray, asked: np.ndarray, k: int) -> int:
        """How many lists hold ``AIM`` of the k nearest in the sample."""
        home = self.order(unit, 1)[:, 0]
        close = unit[asked] @ unit.T
        close[np.arange(len(asked)), asked] = -2
        nearest = np.argsort(-close, axis=1, kind="stable")[:, :k]
        ranks = np.argsort(self.order(unit[asked], len(self.centroids)), axis=1)
        needed = np.sort(ranks[np.arange(len(asked))[:, None], home[nearest]].ravel())
        return int(needed[min(len(needed) - 1, int(AIM * len(needed)))]) + 1 if len(needed) else 1


def scan(q_id: int, q: np.ndarray, ids: np.ndarray, data: np.ndarray, state: dict, lists: Lists, k: int):
    """The k nearest found in a block: (ids, cosines)."""
    if "turned" not in state:
        state["turned"] = lists.turned(data)
        state["norms"] = np.sqrt((data * data).sum(axis=1))
    turned, dim = state["turned"], data.shape[1]
    target = lists.turned(q[None, :])[0]
    alive = np.flatnonzero(ids != q_id)
    partial = np.zeros(len(alive))
    best = math.inf
    for at in range(0, dim, COLUMNS):
        columns = slice(at, min(dim, at + COLUMNS))
        partial += ((turned[alive, columns] - target[columns]) ** 2).sum(axis=1)
        read = columns.stop
        if read >= dim or len(alive) <= 4 * k:
            break
        if at == 0:  # a first k-th best, from those that look nearest
            look = alive[np.argpartition(partial, 4 * k)[: 4 * k]]
            best = np.sort(((turned[look] - target) ** 2).sum(axis=1))[k - 1]
        keep = partial * (dim / read) <= best * (1 + DOUBT / math.sqrt(read)) ** 2 + 1e-12
        alive, partial = alive[keep], partial[keep]
    scores = (data[alive] * q).sum(axis=1) / (state["norms"][alive] * math.sqrt((q * q).sum()))
    top = np.lexsort((ids[alive], -scores))[:k]
    return ids[alive[top]], scores[top]


def nearest(table: DataFrame, k: int = 5, every: int = 50, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest found by cosine.

    ``table`` has vec_id and embedding; other columns are left out. Queries are the rows whose
    vec_id is divisible by ``every``; candidates are all other rows of as many dimensions. The
    lists are fitted on at most ``SAMPLE_ROWS`` rows, every row is in one, and a query probes as
    many as held ``AIM`` of the neighbours in the sample, or more until they hold 64 k rows.
    Scores are exact, ties go to the smaller vec_id.

    Rows with a null vec_id, and vectors that are null, empty, zero, hold a null or a value that
    is not finite take no part. Rows that share a vec_id count as one (the smallest vector). An
    empty table gives an empty table.
    """
    fine = usable(table, zero=False, most=1e150)
    spark = table.sparkSession
    found = None
    for dim, rows in sorted(fine.groupBy("dim").count().collect()):
        part = fine.where(F.col("dim") == dim)
        size = max(256, min(SAMPLE_ROWS, SAMPLE_VALUES // dim))
        drawn = part.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("vector").toPandas()
        lists = Lists(np.stack(drawn["vector"].to_numpy()), rows, k, seed)
        shared = spark.sparkContext.broadcast(lists)

        def assign(batches: Iterator[pa.RecordBatch], shared=shared, sizes=None) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                vectors = np.stack(batch.column("vector").to_numpy(zero_copy_only=False))
                unit = shared.value.turned(vectors)
                if sizes is None:
                    near = shared.value.order(unit, 1)
                    taken = np.ones(len(unit), np.int64)
                else:
                    near = shared.value.order(unit, len(shared.value.centroids))
                    enough = (np.cumsum(sizes[near], axis=1) < 64 * k).sum(axis=1) + 1
                    taken = np.minimum(np.maximum(enough, shared.value.probes), near.shape[1])
                row = np.repeat(np.arange(len(unit)), taken)
                cell = np.concatenate([near[i, :n] for i, n in enumerate(taken.tolist())])
                where = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int64)), batch.column("vec_id").take(where), batch.column("vector").take(where)],
                    ["list", "vec_id", "vector"],
                )

        columns, schema = part.select("vec_id", "vector"), "list long, vec_id long, vector array<double>"
        listed = columns.mapInArrow(assign, schema)
        sizes = np.zeros(len(lists.centroids), np.int64)
        for r in listed.groupBy("list").count().collect():  # at most MOST_LISTS rows
            sizes[r["list"]] = r["count"]
        asked = columns.where(F.col("vec_id") % every == 0).mapInArrow(
            lambda b, a=assign, s=sizes: a(b, sizes=s), schema
        )
        held = blocks(listed, ["list"], BLOCK, "c")
        wanted = blocks(asked, ["list"], QUERY_BLOCK, "q").withColumnRenamed("list", "_of")
        pairs = held.join(wanted, F.col("list") == F.col("_of")).select("c_ids", "c_data", "q_ids", "q_data")

        def search(q_id, q, ids, data, state, shared=shared):
            return scan(q_id, q, ids, data, state, shared.value, k)

        one = searched(pairs, search, "double")
        found = one if found is None else found.union(one)
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    return ranked(found, k)
