"""Phrase collocations per language, counted by direct-address tiling.

Texts are cut into pieces at punctuation and line ends and pieces into words (A-Z taken as
a-z). Words seen at least ``least`` times in their language get ids ranked by frequency, the
most frequent smallest, across all languages at once (an id says its language). Each level
then counts pairs (id of a frequent phrase of k - 1 words, id of the next word) inside Python
tasks: pairs whose two ids are both below ``tile`` land in one dense tile counted by
``numpy.bincount``; all other pairs are sorted 64-bit keys counted as COO runs. The tasks'
partial counts travel packed in arrays, by buckets of pairs, and are summed bucket by bucket. Pairs seen ``least`` times are the frequent phrases of k words;
they are ranked by frequency again and become the left side of the next level's pairs, up
to ``longest`` words. A phrase can only reach ``least`` if its first k - 1 words do, so the
levels count every candidate exactly.

Each document keeps two id arrays between levels (written to the shared folder): its words
and the phrases of the current length starting at each place, -1 where nothing frequent
starts (a piece boundary ends every run). Dictionaries go to the workers in chunks of at most
``chunk`` entries; a bigger dictionary takes more passes, never a bigger broadcast.

Scores are exact: ``floor(1000 * a * n / (l * r))`` is taken in 38-digit decimals, and it
fits a long, as l and r are at least a.

Defined cases: a null text counts as empty and a null lang as ``und``; empty pieces and
empty words are skipped; an empty table, or one without frequent phrases, gives no rows;
repeated rows count each time they occur; ties in score are broken by a, then by the phrase
in UTF-8 byte order; other columns of ``docs`` are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import flat, listed, mix64, python_ready, runs
from tidemark.session import checkpointed, shared_folder

# Fixed values of the contract: piece and word separators, A-Z only lowered.
PIECE = "[.,;:!?\\x0A-\\x0D]"
GAP = "[\\x20\\x09]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST = 100
LONGEST = 5
TOP = 2000
TILE = 1024
CHUNK = 1 << 21
FLUSH = 1 << 22


def _dense_ids(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``id`` 0, 1, 2, ... in the given order, numbered without one task seeing all rows."""
    ordered = checkpointed(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", 33)
    sizes = ordered.groupBy(part.alias("_part")).count()
    offsets = sizes.select(
        "_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_offset")
    )
    numbered = ordered.join(F.broadcast(offsets), part == F.col("_part"))  # one row a partition
    return numbered.select(
        *df.columns, (F.col("_offset") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).cast("int").alias("id")
    )


def _chunks(dictionary: DataFrame, columns: list[str], size: int, chunk: int) -> Iterator[pa.Table]:
    """The dictionary in id ranges of at most ``chunk`` rows, each gathered on its own."""
    for first in range(0, size, chunk):
        yield dictionary.where(F.col("id").between(first, first + chunk - 1)).select(*columns).toArrow()


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder, and where, so that it can be dropped once read."""
    path = f"{shared_folder(df.sparkSession)}/phrases-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _drop(spark, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def word_ids(texts: pa.Array, langs: np.ndarray, lookup) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of lowered ``texts`` with -1 after each piece, and the rows' bounds.

    ``lookup(lang, words)`` gives ids (-1 where unknown) for an array of words of one language.
    """
    pieces = pc.split_pattern_regex(pc.fill_null(texts, ""), PIECE)
    piece_rows = np.asarray(pieces.offsets) - np.asarray(pieces.offsets)[0]
    flat_pieces = pieces.flatten()
    words = pc.split_pattern_regex(flat_pieces, GAP)
    word_rows = np.asarray(words.offsets) - np.asarray(words.offsets)[0]
    flat_words = words.flatten()
    n_pieces = len(flat_pieces)
    piece_of = np.repeat(np.arange(n_pieces), np.diff(word_rows))
    keep = np.asarray(pc.greater(pc.binary_length(flat_words), 0), bool) if len(flat_words) else np.zeros(0, bool)
    ids = np.full(len(flat_words), -1, np.int64)
    lang_of = langs[np.repeat(np.arange(len(texts)), np.diff(piece_rows))][piece_of] if len(piece_of) else langs[:0]
    for lang in np.unique(lang_of[keep]) if keep.any() else []:
        chosen = np.flatnonzero(keep & (lang_of == lang))
        ids[chosen] = lookup(lang, flat_words.take(pa.array(chosen)).to_numpy(zero_copy_only=False))
    ids, piece_of = ids[keep], piece_of[keep]
    per_piece = np.bincount(piece_of, minlength=n_pieces) + 1
    starts = np.concatenate(([0], np.cumsum(per_piece)))
    out = np.full(starts[-1], -1, np.int64)
    before = np.concatenate(([0], np.cumsum(per_piece - 1)))
    out[starts[piece_of] + np.arange(len(ids)) - before[piece_of]] = ids
    return out, starts[piece_rows]


_INDEXES: dict = {}


def _encode(texts: DataFrame, words: DataFrame, chunk: int) -> tuple[DataFrame, str | None]:
    """Per document ``x``, the word ids with -1 for rare words and after each piece, and ``g`` = ``x``."""
    spark = texts.sparkSession
    size = words.count()
    encoded, path = texts.withColumn("x", F.lit(None).cast("array<int>")), None
    rounds = list(_chunks(words, ["lang", "word", "id"], size, chunk)) if size else []
    for number, table in enumerate(rounds):
        known: dict[str, tuple[list[str], np.ndarray]] = {}
        frame = table.to_pandas()
        for lang, part in frame.groupby("lang", sort=False):
            known[lang] = (part["word"].tolist(), part["id"].to_numpy(np.int64))
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, known))  # at most ``chunk`` words
        carry = number + 1 < len(rounds)

        def encode(batches: Iterator[pa.RecordBatch], shared=shared, carry=carry) -> Iterator[pa.RecordBatch]:
            import pandas as pd

            key, known = shared.value
            if key not in _INDEXES:
                _INDEXES.clear()
                _INDEXES[key] = {lang: (pd.Index(w), i) for lang, (w, i) in known.items()}
            indexes = _INDEXES[key]

            def lookup(lang, values):
                if lang not in indexes:
                    return np.full(len(values), -1, np.int64)
                index, ids = indexes[lang]
                at = index.get_indexer(values)
                return np.where(at >= 0, ids[np.maximum(at, 0)], -1)

            for batch in batches:
                langs = np.asarray(batch.column("lang").to_pylist(), object)
                x, rows = word_ids(batch.column("text"), langs, lookup)
                prior = batch.column("x")
                if prior.null_count < len(prior):
                    x = np.maximum(x, _flat(batch, "x")[0])
                kept = ["lang", "text"] if carry else []
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *_lists(rows, x)], names=[*kept, "x"])

        schema = "lang string, text string, x array<int>" if carry else "x array<int>"
        encoded, written = _stored(encoded.mapInArrow(encode, schema))
        if path:
            _drop(spark, path)
        path = written
        shared.unpersist()
    return encoded.select("x", F.col("x").alias("g")), path


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    offsets = np.asarray(column.offsets)
    values = np.asarray(column.values, np.int64) if len(column.values) else np.zeros(0, np.int64)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pairs(x: np.ndarray, g: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) of every place where a frequent phrase of ``span`` words is followed by a frequent word
    and the phrase of its last ``span`` words is frequent too (else the longer one cannot be)."""
    if len(x) <= span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = g[: len(g) - span], x[span:]
    ok = (left >= 0) & (right >= 0) & (g[1 : len(g) - span + 1] >= 0)
    return left[ok], right[ok]


class Tally:
    """A task's partial pair counts: a dense tile for small ids, sorted COO keys for the rest."""

    def __init__(self, span: int, tile: int, parts: int):
        self.span, self.tile, self.parts = span, tile, parts
        self.dense = np.zeros(tile * tile, np.int64)
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, x: np.ndarray, g: np.ndarray) -> Iterator[pa.RecordBatch]:
        p, w = _pairs(x, g, self.span)
        small = (p < self.tile) & (w < self.tile)
        self.dense += np.bincount(p[small] * self.tile + w[small], minlength=self.tile * self.tile)
        k = (p[~small] << 32) | w[~small]
        if len(k):
            unique, runs = np.unique(k, return_counts=True)
            self.keys.append(unique)
            self.counts.append(runs)
            self.held += len(unique)
        if self.held > FLUSH:
            yield from self._sparse()

    def _sparse(self) -> Iterator[pa.RecordBatch]:
        merged, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        summed = np.bincount(at, weights=np.concatenate(self.counts), minlength=len(merged)).astype(np.int64)
        self.keys, self.counts, self.held = [], [], 0
        yield from self._packed(merged, summed)

    def _packed(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counted pairs as arrays, a row for each bucket."""
        part = (mix64(keys.astype(np.uint64)) % np.uint64(self.parts)).astype(np.int32)
        pairs = {"p": (keys >> 32).astype(np.int32), "w": (keys & 0xFFFFFFFF).astype(np.int32), "c": counts}
        found, lists = listed(np.argsort(part, kind="stable"), part, pairs)
        whole = pa.RecordBatch.from_arrays([pa.array(found), *lists.values()], names=["part", *lists])
        for first in range(0, len(found), step := max(1, len(found) // 16)):
            yield whole.slice(first, step)

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.keys:
            yield from self._sparse()
        cells = np.flatnonzero(self.dense)
        if len(cells):
            yield from self._packed((cells // self.tile << 32) | cells % self.tile, self.dense[cells])


def _lists(rows: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(v.astype(np.int32))) for v in values]


def _pair_counts(encoded: DataFrame, span: int, tile: int, parts: int, least: int) -> DataFrame:
    """(p, w, f) of all pairs of a phrase of ``span`` words and the next word that occur ``least`` times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(span, tile, parts)
        for batch in batches:
            yield from tally.add(_flat(batch, "x")[0], _flat(batch, "g")[0])
        yield from tally.finish()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "part"):
            keys, at = np.unique((flat(rows, "p").astype(np.int64) << 32) | flat(rows, "w"), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, flat(rows, "c"))
            often = sums >= least
            keys, sums = keys[often], sums[often]
            columns = [(keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), sums]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["p", "w", "f"])

    packed = encoded.select("x", "g").mapInArrow(count, "part int, p array<int>, w array<int>, c array<long>")
    dealt = packed.repartition("part").sortWithinPartitions("part")  # arrays of one bucket at a time
    return dealt.mapInArrow(total, "p int, w int, f long")


def _advance(encoded: DataFrame, grams: DataFrame, size: int, span: int, chunk: int) -> tuple[DataFrame, str]:
    """``g`` moved one word on: the id of the frequent phrase of ``span + 1`` words at each place, else -1."""
    spark = encoded.sparkSession
    moved, path = encoded.withColumn("h", F.lit(None).cast("array<int>")), None
    rounds = list(range(0, size, chunk))
    for number, table in enumerate(_chunks(grams, ["p", "w", "id"], size, chunk)):
        last = number + 1 == len(rounds)
        order = np.argsort(
            (np.asarray(table.column("p"), np.int64) << 32) | np.asarray(table.column("w"), np.int64), kind="stable"
        )
        keys = ((np.asarray(table.column("p"), np.int64) << 32) | np.asarray(table.column("w"), np.int64))[order]
        shared = spark.sparkContext.broadcast((keys, np.asarray(table.column("id"), np.int32)[order]))

        def look(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            keys, ids = shared.value
            for batch in batches:
                x, rows = _flat(batch, "x")
                g, _ = _flat(batch, "g")
                h = np.full(len(x), -1, np.int64)
                if len(x) > span:
                    left, right = g[: len(g) - span], x[span:]
                    ok = (left >= 0) & (right >= 0)
                    wanted = (left << 32) | right
                    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
                    hit = ok & (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)
                    h[: len(h) - span][hit] = ids[at[hit]]
                old = batch.column("h")
                if old.null_count < len(old):
                    prior, _ = _flat(batch, "h")
                    h = np.maximum(h, prior)
                if last:
                    yield pa.RecordBatch.from_arrays(_lists(rows, x, h), names=["x", "g"])
                else:
                    yield pa.RecordBatch.from_arrays(_lists(rows, x, g, h), names=["x", "g", "h"])

        moved, written = _stored(moved.mapInArrow(look, "x array<int>, g array<int>" if last else "x array<int>, g array<int>, h array<int>"))
        if path:
            _drop(spark, path)
        path = written
        shared.unpersist()
    return moved, path


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, tile: int = TILE, chunk: int = CHUNK):
    """All phrases of 1 to ``longest`` words seen ``least`` times in their language, and words per language.

    Returns (phrases: lang, words array, phrase, length, f; totals: lang, n).
    """
    python_ready(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER).alias("text"),
    )
    tokens = texts.select("lang", F.explode(F.split("text", f"{PIECE}|{GAP}")).alias("word")).where("word <> ''")
    counted = checkpointed(tokens.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")))
    totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    words = checkpointed(_dense_ids(counted.where(F.col("f") >= least), F.desc("f"), "lang", "word"))
    size = words.count()
    level = words.select("lang", "id", F.array("word").alias("words"), "f")
    levels = [level]
    encoded, path = _encode(texts, words, chunk) if size else (None, None)
    n = totals.agg(F.sum("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n >> 21)
    for span in range(1, longest):
        if encoded is None or size == 0:
            break
        counts = checkpointed(_pair_counts(encoded, span, tile, parts, least))  # else the order's sample counts twice
        grams = checkpointed(_dense_ids(counts, F.desc("f"), "p", "w"))
        size = grams.count()
        left, right = level.alias("l"), words.alias("r")
        level = checkpointed(
            grams.alias("g")
            .join(left, F.col("g.p") == F.col("l.id"))
            .join(right, F.col("g.w") == F.col("r.id"))
            .select("l.lang", F.col("g.id").alias("id"), F.concat("l.words", F.array("r.word")).alias("words"), "g.f")
        )
        levels.append(level)
        if span + 1 < longest and size:
            encoded, moved = _advance(encoded, grams, size, span, chunk)
            _drop(docs.sparkSession, path)
            path = moved
    if path:
        _drop(docs.sparkSession, path)
    phrases = levels[0]
    for more in levels[1:]:
        phrases = phrases.unionByName(more)
    phrases = phrases.select(
        "lang", "words", F.array_join("words", " ").alias("phrase"), F.size("words").alias("length"), "f"
    )
    return phrases, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, **tuning) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words by their weakest cut's score.

    Returns lang, rank, phrase, a, l, r, n, score (all numbers long); see the module for the rules.
    """
    phrases, totals = frequent_phrases(docs, least, longest, **tuning)
    known = phrases.select("lang", "phrase", "f")
    candidates = phrases.where(F.col("length") >= 2).join(totals, "lang")
    cuts = candidates.select(
        "lang", "phrase", "words", F.col("f").alias("a"), "n", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")
    ).select(
        "*",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"),
    )
    first = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "decimal(38,0)"
    scored = (
        cuts.join(first, ["lang", "first"])
        .join(rest, ["lang", "rest"])
        .withColumn(
            "score",
            F.expr(f"(1000 * cast(a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))").cast("long"),
        )
    )
    weakest = scored.groupBy("lang", "phrase", "words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inside = (
        phrases.where(F.col("length") >= 3)
        .select("lang", "words", "f", F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("m"))
        .select("lang", "words", "f", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("i"))
        .select("lang", F.array_join(F.slice("words", F.col("i"), F.col("m")), " ").alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    kept = weakest.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") < F.col("a"))
    )
    ranked = kept.select(
        "lang",
        F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")).alias("rank"),
        "phrase",
        "a",
        "cut.l",
        "cut.r",
        "n",
        "cut.score",
    ).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", *(F.col(c).cast("long") for c in "a l r n score".split()))
