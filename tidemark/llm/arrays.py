"""Texts as NumPy arrays inside a task: words, shingles and their hashes, a batch at a time.

Words are runs of bytes other than the ASCII white space characters, so all work is on the
UTF-8 bytes of an Arrow column. A span's hash is a polynomial over its bytes, read off
prefix sums modulo 2**64 and then mixed; no per-row Python touches the characters.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 1 << 18  # arrays of eight bytes for each then stay in the cache
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_CODES = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64)
#: What each byte adds to a hash: as it is, and with A-Z taken as a-z.
EXACT, FOLDED = _BYTE_CODES, _BYTE_CODES[_LOWER]
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def python_ready(spark: SparkSession) -> None:
    """Arrow batches of bounded size, as rows may be very long, and this package on the workers' path.

    Where the package is installed or shipped in another way, the path changes nothing.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (fixed values of Murmur3)."""
    moved = x >> np.uint64(33)
    x = x ^ moved
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x *= np.uint64(factor)
        x ^= np.right_shift(x, np.uint64(33), out=moved)
    return x


def mix32(x: np.ndarray) -> np.ndarray:
    """The same for 32-bit words."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the bounds of its rows; null counts as empty."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, bounds


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``size`` bytes: (first row, end row, bytes, bounds from 0).

    A longer text is a run of its own, so every text is seen whole.
    """
    if not len(column):
        return
    data, bounds = text_bytes(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for slot, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _POWERS[slot] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


class SpanHash:
    """Hashes of any spans of ``data``: equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, codes: np.ndarray = FOLDED):
        powers, self._inverse = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(codes[data] * powers[: len(data)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64(self._unmixed(start, end))

    def _unmixed(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._sums[end] - self._sums[start]) * self._inverse[start]

    def windows(self, points: np.ndarray, width: int, chosen: np.ndarray, short: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes from each of ``points[chosen]`` to the point ``width`` further on; those at ``short`` of spans instead.

        ``points`` are ascending and more than ``width``, and no other chosen one is among the last ``width - 1``.
        """
        if len(points) == len(self._sums) - 1:  # every byte is a point
            sums, inverse = self._sums, self._inverse[: len(points) - width + 1]
        else:
            sums = np.append(self._sums[points], self._sums[-1])
            inverse = self._inverse[points[: len(points) - width + 1]]
        ahead = (sums[width:] - sums[:-width]) * inverse
        values = ahead[np.minimum(chosen, len(ahead) - 1)]
        values[short] = self._unmixed(start, end)
        return mix64(values)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each row (rows + 1 values)."""
    word = ~_SPACE[data]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    lasts = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    start[firsts], end[lasts] = word[firsts], word[lasts]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, bounds)


def sorted_sets(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in ascending order, and the new row bounds."""
    values = values.copy()
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[rows[:-1][rows[:-1] < rows[1:]]] = True
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[rows]


def word_shingles(data: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each row's set of shingles (64-bit hashes, sorted) and the row bounds.

    A-Z counts as a-z. With fewer than ``width`` words the whole sequence is the one shingle.
    """
    start, end, words = word_spans(data, bounds)
    hashed = SpanHash(data)(start, end)
    counts = np.diff(words)
    weights = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    rows = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat(words[:-1] - rows[:-1], n) + np.arange(rows[-1])
    total = np.zeros(len(at), np.uint64)
    size = np.repeat(np.minimum(counts, width), n)
    for k in range(width):
        inside = size > k
        total += np.where(inside, hashed[np.minimum(at + k, max(len(hashed) - 1, 0))] * weights[k], np.uint64(0))
    return sorted_sets(mix64(total + size.astype(np.uint64)), rows)


def reduce_rows(ufunc: np.ufunc, values: np.ndarray, rows: np.ndarray, empty) -> np.ndarray:
    """``ufunc`` over each row's values; ``empty`` where a row has none."""
    out = np.full(len(rows) - 1, empty, values.dtype)
    some = rows[:-1] < rows[1:]
    if some.any():
        out[some] = ufunc.reduceat(values, rows[:-1][some])
    return out


def listed(order: np.ndarray, groups: np.ndarray, columns: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The distinct ``groups``, which ``order`` sorts, and for each its values of every column as a list."""
    groups = groups[order]
    starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    offsets = pa.array(np.append(starts, len(groups)), pa.int32())
    return groups[starts], {c: pa.ListArray.from_arrays(offsets, pa.array(v[order])) for c, v in columns.items()}


def runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """The rows of each value of ``by``, by which the batches are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(by).to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(by)[0].as_py() != values[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def flat(rows: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    """The values of a column of lists."""
    return pc.list_flatten(rows.column(name)).to_numpy()


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return both, a.size + b.size - both
