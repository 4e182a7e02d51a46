"""Links between similar items: candidate pairs from shared buckets, and connected components.

A bucket may hold any number of items, so no bucket is expanded into all its pairs at once.
First every member meets the bucket's smallest member; verified links are joined into
components. Only buckets that still hold several components are compared further, in blocks
of bounded size. There only pairs across components are confirmed whose signatures leave a
link open, likeliest first, and only links that join components come out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import flat, jaccard_counts, listed, mix64, python_ready, runs
from tidemark.session import checkpointed

BLOCK = 1024
FEW = 8
BROADCAST_BYTES = 64 << 20
GATHER = 1 << 20
SLICE_BITS = 19


def _moved(name: str) -> Column:
    return F.col(name).bitwiseXOR(F.lit(1)).alias("_moved")


def sized(rows: DataFrame, row_bytes: int) -> DataFrame:
    """``rows`` written once, and marked for broadcast if their count shows them to be small."""
    rows = checkpointed(rows)
    return F.broadcast(rows) if rows.count() * row_bytes <= BROADCAST_BYTES else rows


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """(band, key, id, pivot) of buckets with several items; ``pivot`` is the smallest. Written once.

    Most keys occur once. They are found by counting keys alone, so that the wide shuffle has
    the fewest bytes and what goes on is small. Lookups join on a value that the grouping has
    not arranged, so a very large bucket can be split over tasks at run time.
    """
    often = buckets.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").select(_moved("key"))
    met = checkpointed(buckets.join(often, F.col("key").bitwiseXOR(F.lit(1)) == F.col("_moved")).select("band", "key", "id"))
    several = (
        met.groupBy("key")
        .agg(F.min("id").alias("pivot"), F.max("id").alias("_last"))
        .where("pivot < _last")
        .select(_moved("key"), "pivot")
    )
    found = met.join(several, F.col("key").bitwiseXOR(F.lit(1)) == F.col("_moved"))
    return checkpointed(found.select("band", "key", "id", "pivot"))


def _shared_keys(lists: DataFrame) -> DataFrame:
    """(key, pivot) of keys with several ids, from (id, keys). Written once.

    Keys travel packed in arrays, each with the smallest and the largest id that a part of a task has for it.
    """
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def emit() -> pa.RecordBatch:
            key, item = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            order = np.lexsort((item, key))
            key, item = key[order], item[order]
            new = np.concatenate(([True], key[1:] != key[:-1]))
            last = np.append(new[1:], True)
            ends = new | (last & np.concatenate(([False], item[1:] != item[:-1])))
            key, item = key[ends], item[ends]
            part = (mix64(key.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            found, columns = listed(np.argsort(part, kind="stable"), part, {"key": key, "id": item})
            return pa.RecordBatch.from_arrays([pa.array(found), columns["key"], columns["id"]], ["part", "key", "id"])

        for batch in batches:
            ids = batch.column("id").to_numpy()
            held.append((flat(batch, "keys"), np.repeat(ids, pc.list_value_length(batch.column("keys")).to_numpy())))
            if sum(len(h[0]) for h in held) > GATHER:
                yield emit()
        if sum(len(h[0]) for h in held):
            yield emit()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "part"):
            key, item = flat(rows, "key"), flat(rows, "id")
            order = np.lexsort((item, key))
            key, item = key[order], item[order]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            several = item[starts] < item[np.append(starts[1:], len(key)) - 1]
            yield pa.RecordBatch.from_arrays([pa.array(x[starts[several]]) for x in (key, item)], ["key", "pivot"])

    packed = lists.mapInArrow(pack, "part int, key array<long>, id array<long>")
    dealt = packed.repartition("part").sortWithinPartitions("part")
    return checkpointed(dealt.mapInArrow(meet, "key long, pivot long"))


def _bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits (a power of two), set at the low bits of every key; gathered in slices."""
    low = min(SLICE_BITS, bits.bit_length() - 1)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "slice"):
            marked = np.zeros(1 << low, bool)
            marked[rows.column("at").to_numpy() & ((1 << low) - 1)] = True
            part = [pa.array([rows.column("slice")[0].as_py()]), pa.array([np.packbits(marked).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(part, ["slice", "bits"])

    at = keys.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("at")).distinct()
    dealt = at.withColumn("slice", F.shiftright("at", low)).repartition("slice").sortWithinPartitions("slice")
    out = np.zeros(bits // 8, np.uint8)
    slices = dealt.mapInArrow(fill, "slice long, bits binary").toArrow()
    for number, data in zip(slices.column("slice").to_pylist(), slices.column("bits").to_pylist(), strict=True):
        out[number << (low - 3) : (number + 1) << (low - 3)] = np.frombuffer(data, np.uint8)
    return out


def shared_bands(lists: DataFrame) -> DataFrame:
    """:func:`shared_buckets` of (id, keys): the k-th key of a list is that of band k. Each row once.

    Keys must be well mixed. Keys that occur once, most of them, are told by a bitmap of at most
    ``BROADCAST_BYTES`` and leave before anything is shuffled row by row; those it lets through
    wrongly leave in the join.
    """
    python_ready(lists.sparkSession)
    several = _shared_keys(lists)
    bits = max(1 << 10, min(BROADCAST_BYTES * 8, 1 << (16 * several.count()).bit_length()))
    shared = lists.sparkSession.sparkContext.broadcast(_bitmap(several, bits))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, sizes = flat(batch, "keys"), pc.list_value_length(batch.column("keys")).to_numpy()
            at = key & (bits - 1)
            hit = np.flatnonzero((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            band = hit - (np.cumsum(sizes) - sizes)[row]
            columns = [band.astype(np.int32), key[hit], batch.column("id").to_numpy()[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["band", "key", "id"])

    found = lists.mapInArrow(pick, "band int, key long, id long").distinct().join(several, "key")
    return checkpointed(found.select("band", "key", "id", "pivot"))


def pivot_pairs(shared: DataFrame) -> DataFrame:
    """(a, b) with a < b: every member with its bucket's smallest member, each pair once."""
    return shared.where("id > pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()


def open_members(shared: DataFrame, parts: DataFrame, items: DataFrame) -> DataFrame:
    """``items`` (id, size, text, ...) in buckets that still span several components.

    Each row has band, key, part and the number of ``blocks`` its bucket is compared in.
    ``parts`` is (node, component) of linked items; any other item is its own component.
    """
    labelled = shared.join(parts, shared["id"] == parts["node"], "left").select(
        "band", "key", "id", F.coalesce("component", "id").alias("part")
    )
    labelled = checkpointed(labelled)
    split = (
        labelled.groupBy("key")
        .agg(F.min("part").alias("_least"), F.max("part").alias("_most"), F.count("*").alias("_n"))
        .where("_least < _most")
        .select(_moved("key"), F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks"))
    )
    still = labelled.join(split, F.col("key").bitwiseXOR(F.lit(1)) == F.col("_moved"))
    return still.select("band", "key", "id", "part", "blocks").join(items, "id")


class _Parts:
    """Union-find over the components that meet in one block."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.above.get(x, x) != x:
            x = self.above[x]
        return x


class _Block:
    """Columns of a batch of open members as arrays, from which groups of rows are compared."""

    def __init__(self, batch: pa.RecordBatch, signature, sets, bands: int, rows: int, share: float, percent: int):
        self.batch, self.sets, self.bands, self.rows, self.share, self.percent = batch, sets, bands, rows, share, percent
        names = ("key", "_low", "_high", "band", "id", "part", "size", "_own")
        self.cols = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names}
        self.sig = signature(batch)

    def groups(self) -> list[int]:
        """Where groups of equal key and block pair start, and the end."""
        change = np.zeros(max(0, self.batch.num_rows - 1), bool)
        for c in ("key", "_low", "_high"):
            change |= self.cols[c][1:] != self.cols[c][:-1]
        return [0, *(np.flatnonzero(change) + 1).tolist(), self.batch.num_rows]

    def links(self, cuts: list[int]) -> list[tuple[int, int]]:
        """Confirmed links that join components, of all groups between ``cuts``; ids are sorted in a group."""
        sizes = np.diff(cuts)
        group = np.repeat(np.arange(len(sizes)), sizes)
        near: list[tuple[int, float, int, int]] = []
        few = np.append(sizes <= FEW, False)
        for gap in range(1, FEW):  # small groups, which are most, all at once
            x = np.flatnonzero((group[:-gap] == group[gap:]) & few[group[:-gap]])
            near += self._candidates(group, x, x + gap)
        for k in np.flatnonzero(sizes > FEW).tolist():
            low, high = cuts[k], cuts[k + 1]
            part = self.cols["part"][low:high]
            if (part == part[0]).all():
                continue
            step = max(1, (1 << 16) // (high - low))
            for at in range(low, high, step):
                x, y = np.nonzero(np.arange(low, high)[None] > np.arange(at, min(at + step, high))[:, None])
                near += self._candidates(group, x + at, y + low)
        return self._confirmed(sorted(near))

    def _candidates(self, group: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(group, disagreement, row, row) of those pairs of rows that may be links."""
        c = self.cols
        small, large = np.minimum(c["size"][x], c["size"][y]), np.maximum(c["size"][x], c["size"][y])
        fits = (c["part"][x] != c["part"][y]) & (100 * small >= self.percent * large)
        fits &= (c["_low"][x] == c["_high"][x]) | (c["_own"][x] != c["_own"][y])
        x, y = x[fits], y[fits]
        out: list[tuple[int, float, int, int]] = []
        for cut in range(0, len(x), 1 << 14):
            i, j = x[cut : cut + (1 << 14)], y[cut : cut + (1 << 14)]
            equal = self.sig[i] == self.sig[j]
            agree = equal.mean(axis=1)
            good = agree >= self.share
            i, j, equal, agree = i[good], j[good], equal[good], agree[good]
            whole = equal[:, : self.bands * self.rows].reshape(len(i), self.bands, self.rows).all(axis=2)
            first = whole.argmax(axis=1) == c["band"][i]
            i, j, agree = i[first], j[first], agree[first]
            out += zip(group[i].tolist(), (-agree).tolist(), i.tolist(), j.tolist(), strict=True)
        return out

    def _confirmed(self, near: list[tuple[int, float, int, int]]) -> list[tuple[int, int]]:
        links, joined, current = [], _Parts(), -1
        known = self._sets(near) if near else {}
        for group, _, x, y in near:
            if group != current:
                joined, current = _Parts(), group
            a, b = joined.find(int(self.cols["part"][x])), joined.find(int(self.cols["part"][y]))
            if a == b:  # already linked through others
                continue
            one, two = int(self.cols["id"][x]), int(self.cols["id"][y])
            both, union = jaccard_counts(known[one], known[two])
            if union and 100 * both >= self.percent * union:
                links.append((one, two))
                joined.above[max(a, b)] = min(a, b)
        return links

    def _sets(self, near: list[tuple[int, float, int, int]]) -> dict[int, np.ndarray]:
        """The sets of all rows in ``near``, by id."""
        ids = self.cols["id"]
        once = {int(ids[k]): k for _, _, x, y in near for k in (x, y)}
        return dict(zip(once, self.sets(self.batch.column("text").take(pa.array(list(once.values())))), strict=True))


def cross_links(
    members: DataFrame,
    signature: Callable[[pa.RecordBatch], np.ndarray],
    sets: Callable[[pa.Array], list[np.ndarray]],
    bands: int,
    rows: int,
    share: float,
    percent: int,
) -> DataFrame:
    """Verified (a, b) across the components of open buckets, enough to join all that are linked.

    ``members`` comes from :func:`open_members`. Large buckets are compared block by block. A
    pair is confirmed on whole sets if its sizes allow a link, at least ``share`` of its
    signature agrees, and no earlier band holds both (that band's bucket has them).
    """
    dealt = (
        members.withColumn("_own", F.expr("int(pmod(xxhash64(id), blocks))"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("_low", F.least("_own", "_other"))
        .withColumn("_high", F.greatest("_own", "_other"))
    )
    names = ["key", "_low", "_high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last group, which may go on in the next batch

        def blocks() -> Iterator[tuple[_Block, list[int]]]:
            nonlocal held
            for batch in batches:
                if batch.num_rows:
                    whole = batch if held is None else pa.concat_batches([held, batch])
                    block = _Block(whole, signature, sets, bands, rows, share, percent)
                    cuts = block.groups()
                    held = whole.slice(cuts[-2])
                    yield block, cuts[:-1]
            if held is not None:
                block = _Block(held, signature, sets, bands, rows, share, percent)
                yield block, block.groups()

        for block, cuts in blocks():
            links = block.links(cuts)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])

    arranged = dealt.repartition(*names).sortWithinPartitions(*names, "id")
    return checkpointed(arranged.mapInArrow(compare, "a long, b long"))


def verified(
    pairs: DataFrame,
    texts: DataFrame,
    sets: Callable[[pa.Array], list[np.ndarray]],
    percent: int,
) -> DataFrame:
    """The pairs whose whole sets meet ``100 * intersection >= percent * union``; written once.

    ``texts`` is (id, text); ``sets`` makes the sorted sets of a text column. With their sizes
    in ``texts`` too (size), pairs that these rule out never leave the join.
    """
    known = [c for c in ("text", "size") if c in texts.columns]
    first = texts.select(F.col("id").alias("a"), *(F.col(c).alias(f"{c}_a") for c in known))
    second = texts.select(F.col("id").alias("b"), *(F.col(c).alias(f"{c}_b") for c in known))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {}
            for side in "ab":
                ids = batch.column(side).to_pylist()
                once = {v: k for k, v in reversed(list(enumerate(ids)))}
                taken = sets(batch.column(f"text_{side}").take(pa.array(list(once.values()))))
                cols[side] = (ids, dict(zip(once, taken, strict=True)))
            (a, set_a), (b, set_b) = cols["a"], cols["b"]
            good = []
            for x, y in zip(a, b, strict=True):
                both, union = jaccard_counts(set_a[x], set_b[y])
                good.append(union > 0 and 100 * both >= percent * union)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(first, "a").join(second, "b")
    if "size" in known:
        joined = joined.where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    joined = joined.select("a", "b", "text_a", "text_b")
    return checkpointed(joined.mapInArrow(check, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node that has an edge, and the smallest node it can reach.

    Distributed union-find by alternating stars: every node's larger neighbours move to its
    smallest one, then every node's smaller neighbours do. Stops when the edges stay the same;
    they are then stars around the smallest nodes. Each step is written to the shared folder.
    """
    edges = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least.select(_moved("u"), "m"), F.col("u").bitwiseXOR(F.lit(1)) == F.col("_moved"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.select(_moved("u"), "m"), F.col("u").bitwiseXOR(F.lit(1)) == F.col("_moved"))
        edges = checkpointed(
            small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.union(edges.select(F.col("v"), F.col("v")).distinct())


def joined_parts(parts: DataFrame, more: DataFrame) -> DataFrame:
    """:func:`components` of all the links behind ``parts`` (its result) and of ``more`` (a, b); only whole parts are joined."""
    ends = more
    for c in "ab":
        ends = ends.join(parts.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")), c, "left")
    ends = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    up = checkpointed(components(ends))
    moved = up.select(F.col("node").alias("component"), F.col("component").alias("_up"))
    known = parts.join(moved, "component", "left").select("node", F.coalesce("_up", "component").alias("component"))
    return known.union(up.join(parts, "node", "left_anti"))
