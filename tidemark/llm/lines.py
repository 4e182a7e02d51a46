"""Line dedup across a corpus: fuzzy copies of a line by MinHash, one line of each kind stays.

A line is what stands between line feeds, compared without white space at its ends and with
A-Z as a-z. Lines are sets of character shingles; banded signatures give candidate pairs, the
exact Jaccard similarity confirms them, and components of confirmed pairs are kinds of line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import linking
from tidemark.llm.arrays import SpanHash, flat, mix64, reduce_rows, python_ready, sorted_sets, text_chunks
from tidemark.llm.columns import folded, unfolded
from tidemark.session import checkpointed

WIDTH = 7
BANDS, ROWS = 10, 4
COORDINATES = BANDS * ROWS
PERCENT = 80
LEAST_AGREEMENT = 0.55  # of 40 coordinates: four deviations below 0.8
SEEN_ROWS = 100_000
CHUNK_BYTES = 1 << 17  # larger arrays go back to the system each time
BROADCAST_BYTES = 64 << 20
_FACTORS = np.random.default_rng(11).integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | (data - np.uint8(0x09) < 5)


def line_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and the lines before each row. A row has one line more than line feeds."""
    feeds = np.flatnonzero(data == 0x0A)
    rows = len(bounds) - 1
    before = np.searchsorted(feeds, bounds) + np.arange(rows + 1)
    start = np.empty(before[-1], np.int64)
    end = np.empty(before[-1], np.int64)
    row_of_feed = np.searchsorted(bounds, feeds, "right") - 1
    at = np.arange(len(feeds)) + row_of_feed
    start[before[:-1]], end[before[1:] - 1] = bounds[:-1], bounds[1:]
    start[at + 1], end[at] = feeds + 1, feeds
    return start, end, before


def line_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`line_bounds` without the white space around each line; blank lines have start = end."""
    start, end, before = line_bounds(data, bounds)
    some = start < end
    if not (_blank(data[start[some]]) | _blank(data[end[some] - 1])).any():
        return start, end, before
    solid = np.concatenate((np.flatnonzero(~_blank(data)), [len(data)]))
    first = solid[np.searchsorted(solid, start)]
    last = solid[np.maximum(np.searchsorted(solid, end) - 1, 0)] + 1
    blank = first >= end
    return np.where(blank, start, first), np.where(blank, start, last), before


def character_shingles(hashed: SpanHash, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``WIDTH``-character shingles of each span; a shorter span is one shingle."""
    if data.max(initial=0) < 0x80:
        points, low, high = np.arange(len(data)), start, end
    else:
        points = np.flatnonzero(data & 0xC0 != 0x80)
        low, high = np.searchsorted(points, start), np.searchsorted(points, end)
    sizes = np.where(high > low, np.maximum(high - low - WIDTH + 1, 1), 0)
    rows = np.concatenate(([0], np.cumsum(sizes)))
    at = np.repeat(low - rows[:-1], sizes) + np.arange(rows[-1])
    if 2 * rows[-1] > len(points) > WIDTH:  # most of the text: all windows at once
        short = np.flatnonzero((high > low) & (high - low <= WIDTH))
        return hashed.windows(points, WIDTH, at, rows[short], start[short], end[short]), rows
    points = np.concatenate((points, np.full(WIDTH, len(data))))
    stop = np.minimum(points[at + WIDTH], np.repeat(end, sizes))
    return hashed(points[at], stop), rows


def signatures(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """MinHash with one multiplication a coordinate."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(rows) - 1, COORDINATES), np.uint32)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = reduce_rows(np.minimum, short * factor, rows, np.uint32(0xFFFFFFFF))
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), BANDS, ROWS)
    keys = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix64(keys * np.uint64(31) + parts[:, :, r])
    return mix64(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _columns(column: pa.Array) -> Iterator[tuple]:
    for first, end, data, bounds in text_chunks(column, CHUNK_BYTES):
        start, stop, before = line_spans(data, bounds)
        hashed = SpanHash(data)
        whole = hashed(start, stop).view(np.int64)
        yield first, end, data, start, stop, before, hashed, whole


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(id, doc_id, line, keys) of lines that are not blank; ``id`` hashes the compared text.

    A task leaves out lines it has lately seen; each line's first place is found afterwards.
    """
    python_ready(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, end, data, start, stop, before, hashed, whole in _columns(batch.column("text")):
                row = np.repeat(np.arange(first, end), np.diff(before))
                number = np.arange(before[-1]) - np.repeat(before[:-1], np.diff(before))
                solid = np.flatnonzero(start < stop)
                place = np.lexsort((number[solid], ids[row[solid]], whole[solid]))
                solid = solid[place]
                solid = solid[np.concatenate(([True], whole[solid][1:] != whole[solid][:-1]))[: len(solid)]]
                new = []
                if len(seen) > SEEN_ROWS:
                    seen.clear()
                for k, line, place in zip(
                    solid.tolist(), whole[solid].tolist(), zip(ids[row[solid]].tolist(), number[solid].tolist()), strict=True
                ):
                    known = seen.get(line)
                    if known is None or place < known:
                        seen[line] = place
                        new.append(k)
                new = np.array(sorted(new), np.int64)
                if not len(new):
                    continue
                values, rows = character_shingles(hashed, data, start[new], stop[new])
                keys = _bands(signatures(values, rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(whole[new]),
                        pa.array(ids[row[new]]),
                        pa.array(number[new].astype(np.int32)),
                        pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                    ],
                    ["id", "doc_id", "line", "keys"],
                )

    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return known.mapInArrow(describe, "id long, doc_id long, line int, keys array<long>")


def _sized(lists: DataFrame, column: str, item_bytes: int) -> DataFrame:
    """``lists`` written once, and marked for broadcast if it is known to be small."""
    lists = checkpointed(lists)
    rows, items = lists.agg(F.count("*"), F.coalesce(F.sum(F.size(column)), F.lit(0))).first()
    return F.broadcast(lists) if rows * 64 + items * item_bytes <= BROADCAST_BYTES else lists


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, *map(pa.py_buffer, (bounds.astype(np.int32), data))])


def _listed_lines(column: pa.Array) -> np.ndarray:
    """The row of every value of a column of lists."""
    return np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))


def _places(row: np.ndarray, line: np.ndarray, first: int, end: int, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines (row, line) stand among those of a chunk, and which these are. Others of the rows are not there."""
    own = np.arange(*np.searchsorted(row, (first, end)))
    at = row[own] - first
    own, at = (x[line[own] < before[at + 1] - before[at]] for x in (own, at))
    return before[at] + line[own], own


def _line_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text, size of its set) of the lines in ``wanted`` (id, doc_id, line), text as compared."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, line, ids = _listed_lines(batch.column("line")), flat(batch, "line"), flat(batch, "id")
            for first, end, data, bounds in text_chunks(batch.column("text"), CHUNK_BYTES):
                start, stop, before = line_spans(data, bounds)
                place, own = _places(row, line, first, end, before)
                size = stop[place] - start[place]
                bounds = np.concatenate(([0], np.cumsum(size)))
                data = data[np.repeat(start[place] - bounds[:-1], size) + np.arange(bounds[-1])]
                hashed = SpanHash(data)
                same = hashed(bounds[:-1], bounds[1:]).view(np.int64) == ids[own]
                values, rows = character_shingles(hashed, data, bounds[:-1][same], bounds[1:][same])
                _, sets = sorted_sets(values, rows)
                texts = pc.ascii_lower(_strings(data, bounds)).filter(pa.array(same))
                yield pa.RecordBatch.from_arrays([pa.array(ids[own][same]), texts, pa.array(np.diff(sets))], ["id", "text", "size"])

    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("id", "line")).alias("_at"))  # lines of one document
    places = _sized(places, "_at", 32)
    joined = docs.select(F.col("doc_id").cast("long"), "text").join(places, "doc_id")
    cuts = joined.select(F.col("_at.id").alias("id"), F.col("_at.line").alias("line"), "text").mapInArrow(
        cut, "id long, text string, size long"
    )
    return checkpointed(cuts.dropDuplicates(["id"]))


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted shingle set of every compared line of a column."""
    out = []
    for _, _, data, bounds in text_chunks(column, CHUNK_BYTES):
        values, rows = character_shingles(SpanHash(data), data, bounds[:-1], bounds[1:])
        sets, at = sorted_sets(values, rows)
        out.extend(sets[a:b] for a, b in zip(at[:-1], at[1:], strict=True))
    return out


def _signature(block: pa.RecordBatch) -> np.ndarray:
    parts = [np.empty((0, COORDINATES), np.uint32)]
    for _, _, data, bounds in text_chunks(block.column("text"), CHUNK_BYTES):
        parts.append(signatures(*character_shingles(SpanHash(data), data, bounds[:-1], bounds[1:])))
    return np.concatenate(parts)


def first_places(docs: DataFrame) -> DataFrame:
    """The first place of each kind of line, a struct ``at`` of doc_id and line."""
    lines = checkpointed(distinct_lines(docs))
    firsts = checkpointed(lines.groupBy("id").agg(F.min(F.struct("doc_id", "line")).alias("at")))
    shared = linking.shared_bands(lines.select("id", "keys"))
    wanted = shared.select("id").distinct().join(firsts, "id").select("id", "at.doc_id", "at.line")
    texts = _line_texts(docs, wanted)
    links = linking.verified(linking.pivot_pairs(shared), texts, shingle_sets, PERCENT)
    parts = checkpointed(linking.components(links))
    # a bucket's pivot has met all its members on whole sets; only the others may still be linked
    members = linking.open_members(shared.where("id > pivot"), parts, texts)
    more = linking.cross_links(members, _signature, shingle_sets, BANDS, ROWS, LEAST_AGREEMENT, PERCENT)
    groups = linking.sized(linking.joined_parts(parts, more).withColumnRenamed("node", "id"), 32)
    alone = firsts.join(groups, "id", "left_anti").select("at")
    return alone.union(firsts.join(groups, "id").groupBy("component").agg(F.min("at").alias("at")).select("at"))


def _left(data: np.ndarray, bounds: np.ndarray, stays: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of :func:`line_bounds` with those lines that stay, and their new bounds."""
    start, end, before = line_bounds(data, bounds)
    order = np.cumsum(stays) - stays
    start -= order > np.repeat(order[before[:-1]], np.diff(before))  # all but a row's first follow a line feed
    some = stays & (start < end)
    step = np.zeros(len(data) + 1, np.int8)
    step[start[some]] += 1
    step[end[some]] -= 1
    total = np.concatenate(([0], np.cumsum(np.where(some, end - start, 0))))
    return data[np.cumsum(step[:-1], dtype=np.int8).view(bool)], total[before]


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with each kind of line left at its first place only, and ``n_lines``, ``n_kept``.

    ``docs`` needs doc_id and text; other columns pass through, but for those that bear one of
    the two names. The first place is that of the smallest doc_id, then line number; the kept
    line is the text of that place, unchanged. Blank lines always stay and are counted in
    neither number. The similarity of two lines is that of their sets of ``WIDTH``-character
    shingles (a shorter line is one shingle), and lines are of a kind from ``PERCENT`` on, also
    through others.

    Null and empty texts have no lines and stay as they are. Rows with a null doc_id have no
    place: they stay as they are, with null counts, and no line goes on their account. Rows
    that share a doc_id are the same place, so a repeated row keeps what its first copy keeps.
    A document may lose all its lines; what then remains of its text is blank. An empty table
    gives an empty table.
    """
    given, new = docs, ["n_lines", "n_kept"]
    docs = folded(given, ["doc_id", "text"], new)
    # every occurrence of a line must learn whether it is the kept place: by document
    keep = first_places(docs).select(F.col("at.doc_id").alias("_doc"), F.col("at.line").alias("_line"))
    per_doc = _sized(keep.groupBy("_doc").agg(F.collect_set("_line").alias("_keep")), "_keep", 4)  # lines of one document
    schema = T.StructType(docs.schema.fields + [T.StructField("n_lines", T.LongType()), T.StructField("n_kept", T.LongType())])

    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, line = _listed_lines(batch.column("_keep")), flat(batch, "_keep")
            text, placed = batch.column("text"), pc.is_valid(batch.column("doc_id")).to_numpy(zero_copy_only=False)
            texts, counts = [], []
            for first, end, data, bounds in text_chunks(text, CHUNK_BYTES):
                start, stop, before = line_spans(data, bounds)
                kept = np.zeros(len(start), bool)
                kept[_places(row, line, first, end, before)[0]] = True
                solid = start < stop
                counts.append([np.add.reduceat(x, before[:-1], dtype=np.int64) for x in (solid, solid & kept)])
                texts.append(_strings(*_left(data, bounds, kept | ~solid | np.repeat(~placed[first:end], np.diff(before)))))
            n, left = (pa.array(np.concatenate(x), mask=~placed) for x in zip(*counts, strict=True)) if counts else ([], [])
            texts = pc.if_else(pc.is_valid(text), pa.concat_arrays(texts), None) if texts else text
            columns = [texts if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(n, pa.int64()), pa.array(left, pa.int64())], names + ["n_lines", "n_kept"])

    # a document none of whose lines is a first place has no row in per_doc
    joined = docs.join(per_doc, F.col("doc_id").cast("long") == F.col("_doc"), "left").drop("_doc")
    return joined.mapInArrow(rewrite, schema).select(*unfolded(given, ["doc_id", "text"], new), *new)
