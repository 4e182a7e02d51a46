"""Language-model scoring by cross-entropy difference.

Two bigram models, of target text and of the background (all documents), share one vocabulary,
one set of bigrams and one smoothing. Background counts are scaled to the target's size, so the
models are matched. Every token of a document has a loss under either; the mean of their
differences is the document's score, and the lower it is, the more the text is like the target.

The start of a text is a symbol. With c and C the bigrams' counts,
``p(w | h) = (c(h, w) + m p(w)) / (C(h) + m)`` and ``p(w) = (c(w) + 1) / (N + V + 1)``.

The vocabulary is every word and the bigrams are all there are. Every token travels once, packed
in arrays, to the bucket of its bigram, where all tokens of the bigram meet and are counted; what
they add to their texts travels back as sums. Only the counts of the most frequent words and
totals reach the driver: tasks then name such words by 16-bit ids, and tokens of rare words go
to the bucket of the rare word, which so learns its counts. Pairs too frequent for one bucket
are counted beforehand. With bounds given, a model of the most frequent words (any other is one
symbol) and bigrams is gathered and sent to the tasks instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import SpanHash, flat, listed, mix64, python_ready, reduce_rows, runs, text_chunks, word_spans
from tidemark.llm.columns import folded, unfolded
from tidemark.llm.importance import TARGET_ROWS, labelled_good
from tidemark.llm.linking import sized
from tidemark.session import checkpointed

SMOOTHING = 20.0
GATHER = 1 << 20
DICTIONARY = 65_000  # words whose ids have 16 bits
LAST = 0xFFFF  # stands for what follows a text's last word
ROWS = 32_000  # texts whose places have 15 bits
SHARES = 1024


def _tally(docs: DataFrame, target: np.ndarray, symbols: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(key, background, target): how often each symbol occurs in all texts and in target texts.

    ``symbols(hashes, words)`` turns the word hashes of a run of texts into one key a word.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(target))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        flags: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            distinct, back, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            good = np.bincount(back, weights=np.concatenate(flags), minlength=len(distinct)).astype(np.int64)
            keys.clear()
            flags.clear()
            return pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(n), pa.array(good)], ["key", "background", "target"])

        for batch in batches:
            ids = batch.column("doc_id")
            is_target = np.isin(pc.fill_null(ids, -1).to_numpy(zero_copy_only=False), wanted.value)
            is_target &= pc.is_valid(ids).to_numpy(zero_copy_only=False)
            for first, end, data, bounds in text_chunks(batch.column("text")):
                start, stop, words = word_spans(data, bounds)
                keys.append(symbols(SpanHash(data)(start, stop), words))
                flags.append(np.repeat(is_target[first:end], np.diff(words)))
                if sum(map(len, keys)) > GATHER:
                    yield emit()
        if keys:
            yield emit()

    tallied = docs.select("doc_id", "text").mapInArrow(count, "key long, background long, target long")
    return tallied.groupBy("key").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


@dataclass
class Models:
    """Both models: counts by symbol and by kept bigram, target first, background second."""

    words: np.ndarray  # sorted hashes of the vocabulary
    singles: np.ndarray  # (2, V + 1): the last symbol stands for all other words
    bigrams: np.ndarray  # sorted keys
    pairs: np.ndarray  # (2, number of bigrams)
    smoothing: float = SMOOTHING

    def __post_init__(self) -> None:
        scale = self.singles[0].sum() / max(1.0, self.singles[1].sum())
        self.singles = self.singles * np.array([[1.0], [scale]])
        self.pairs = self.pairs * np.array([[1.0], [scale]])
        total = self.singles.sum(axis=1, keepdims=True)
        self.prior = (self.singles + 1) / (total + self.singles.shape[1])
        context = self.bigrams // self.base
        self.contexts = np.stack([np.bincount(context, weights=p, minlength=self.base) for p in self.pairs])

    @property
    def base(self) -> int:
        return len(self.words) + 2

    def losses(self, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
        """(2, number of words): each token's loss in nats."""
        keys = bigram_keys(hashes, words, self.words)
        context, word = keys // self.base, keys % self.base
        at = np.minimum(np.searchsorted(self.bigrams, keys), max(0, len(self.bigrams) - 1))
        out = np.empty((2, len(keys)))
        for m in range(2):
            count = np.where(self.bigrams[at] == keys, self.pairs[m][at], 0.0) if len(self.bigrams) else 0.0
            mass = self.contexts[m][context] + self.smoothing
            out[m] = -np.log((count + self.smoothing * self.prior[m][word]) / mass)
        return out


def bigram_keys(hashes: np.ndarray, words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """``context * base + word`` for every word; V is any other word, V + 1 the start of a text."""
    size = len(vocabulary)
    at = np.minimum(np.searchsorted(vocabulary, hashes.view(np.int64)), max(0, size - 1))
    ids = np.where(vocabulary[at] == hashes.view(np.int64), at, size) if size else np.zeros(len(hashes), np.int64)
    context = np.empty_like(ids)
    context[1:] = ids[:-1]
    context[words[:-1][words[:-1] < words[1:]]] = size + 1
    return context * (size + 2) + ids


def fit(docs: DataFrame, target: np.ndarray, vocabulary: int, bigrams: int) -> Models:
    """Models counted over every document; ``target`` holds the ids of target documents.

    The vocabulary is the most frequent words, the bigrams are all at or above the least count
    (2 or more, in steps of an eighth of an octave) that leaves at most ``bigrams`` of them.
    """
    python_ready(docs.sparkSession)
    counts = checkpointed(_tally(docs, target, lambda hashes, words: hashes.view(np.int64)))
    top = counts.orderBy(F.desc("background"), "key").limit(vocabulary).toPandas().sort_values("key")
    words = top["key"].to_numpy(np.int64)
    total = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("target", "background"))).first()
    singles = np.zeros((2, len(words) + 1))
    for m, name in enumerate(("target", "background")):
        singles[m, :-1] = top[name]
        singles[m, -1] = total[m] - singles[m].sum()
    shared = docs.sparkSession.sparkContext.broadcast(words)
    pairs = _tally(docs, target, lambda hashes, at: bigram_keys(hashes, at, shared.value)).where("background > 1")
    pairs = checkpointed(pairs.withColumn("_step", F.floor(F.log2(F.col("background").cast("double")) * 8).cast("int")))
    kept, least = 0, 0
    for r in sorted(pairs.groupBy("_step").count().collect(), key=lambda r: -r["_step"]):  # a few hundred rows at most
        kept += r["count"]
        if kept > bigrams:
            least = r["_step"] + 1
            break
    chosen = pairs.where(F.col("_step") >= least).select("key", "target", "background").toArrow()
    keys, *counted = (chosen.column(c).to_numpy() for c in ("key", "target", "background"))
    order = np.argsort(keys)
    return Models(words, singles, keys[order], np.stack([c[order].astype(float) for c in counted]))


def _hashed(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a run of texts, and the row bounds."""
    start, stop, words = word_spans(data, bounds)
    return SpanHash(data)(start, stop).view(np.int64), words


def _edges(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the first and the last word of every text with words stand."""
    some = words[:-1] < words[1:]
    return words[:-1][some], words[1:][some] - 1


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, background, target, last_background, last_target): occurrences, and those that end a text."""
    names = ["background", "target", "last_background", "last_target"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def emit() -> pa.RecordBatch:
            word, good, last = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            distinct, at = np.unique(word, return_inverse=True)
            counts = [np.bincount(at[of], minlength=len(distinct)) for of in (slice(None), good, last, good & last)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (distinct, *counts)], ["word", *names])

        for batch in batches:
            good = batch.column("_good").to_numpy(zero_copy_only=False)
            for first, end, data, bounds in text_chunks(batch.column("text")):
                word, words = _hashed(data, bounds)
                last = np.zeros(len(word), bool)
                last[_edges(words)[1]] = True
                held.append((word, np.repeat(good[first:end], np.diff(words)), last))
                if sum(len(h[0]) for h in held) > GATHER:
                    yield emit()
        if held:
            yield emit()

    tallied = docs.select("text", "_good").mapInArrow(count, ", ".join(f"{c} long" for c in ["word", *names]))
    return tallied.groupBy("word").agg(*(F.sum(c).alias(c) for c in names))


@dataclass
class _Frequent:
    """The most frequent words and what both models know of them; target first, background second."""

    words: np.ndarray  # sorted hashes; a word's id is its place
    counts: np.ndarray  # (2, words)
    contexts: np.ndarray  # (2, words + 1): words that follow; the last is the start of a text
    size: int  # of the whole vocabulary
    total: tuple[int, int]
    hot: np.ndarray  # ids of words that have a share of all tokens
    pairs: np.ndarray  # sorted keys (word << 16 | context) of pairs that are as frequent
    paired: np.ndarray  # (2, pairs)

    @property
    def scales(self) -> np.ndarray:
        return np.array([1.0, self.total[0] / max(1, self.total[1])])

    def prior(self, counts: np.ndarray) -> np.ndarray:
        scales = self.scales[:, None]
        return (counts * scales + 1) / (np.array(self.total, float)[:, None] * scales + self.size + 1)

    def rarity(self, pairs: np.ndarray, prior: np.ndarray) -> np.ndarray:
        """The part of a loss that depends on word and context."""
        return -np.log(pairs * self.scales[:, None] + SMOOTHING * prior)

    def mass(self, contexts: np.ndarray) -> np.ndarray:
        """The part of a loss that depends on the context alone."""
        return np.log(contexts * self.scales[:, None] + SMOOTHING)

    def ids(self, hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and of their contexts, -1 for all others."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        own = np.where(self.words[at] == hashes, at, -1)
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[_edges(words)[0]] = len(self.words)
        return own, before


def _hot_pairs(docs: DataFrame, frequent: _Frequent, least: float) -> DataFrame:
    """(pair, background, target) of pairs of hot words, or of a hot word at a text's start, from ``least`` on."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, held = shared.value, []
        is_hot = np.zeros(len(frequent.words) + 2, bool)  # the last is any other word
        is_hot[frequent.hot] = is_hot[len(frequent.words)] = True

        def emit() -> pa.RecordBatch:
            pair, good = map(np.concatenate, zip(*held, strict=True))
            held.clear()
            distinct, at = np.unique(pair, return_inverse=True)
            counts = [np.bincount(at[of], minlength=len(distinct)) for of in (slice(None), good)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (distinct, *counts)], ["pair", "background", "target"])

        for batch in batches:
            good = batch.column("_good").to_numpy(zero_copy_only=False)
            for first, end, data, bounds in text_chunks(batch.column("text")):
                hashes, words = _hashed(data, bounds)
                own, before = frequent.ids(hashes, words)
                chosen = np.flatnonzero(is_hot[own] & is_hot[before])
                held.append(((own[chosen] << 16) | before[chosen], np.repeat(good[first:end], np.diff(words))[chosen]))
                if sum(len(h[0]) for h in held) > GATHER:
                    yield emit()
        if held:
            yield emit()

    tallied = docs.select("text", "_good").mapInArrow(count, "pair long, background long, target long")
    summed = tallied.groupBy("pair").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))
    return summed.where(F.col("background") >= least)


def _frequent(docs: DataFrame, buckets: int) -> _Frequent:
    """Counts of every word; the most frequent ones, and at most ``SHARES`` frequent pairs, are gathered."""
    words = checkpointed(_word_counts(docs))
    sums = words.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("target", "background", "last_target", "last_background")))
    size, *total = sums.first()
    top = words.orderBy(F.desc("background"), "word").limit(DICTIONARY).toArrow().sort_by("word")
    column = {c: top.column(c).to_numpy() for c in top.column_names}
    counts = np.stack([column["target"], column["background"]])
    follows = counts - np.stack([column["last_target"], column["last_background"]])
    contexts = np.concatenate((follows, np.array(total[2:])[:, None]), axis=1)
    least = total[1] / min(4 * buckets, SHARES)
    hot = np.flatnonzero(column["background"] >= least)
    none = np.zeros(0, np.int64)
    out = _Frequent(column["word"], counts, contexts, size, (total[0], total[1]), hot, none, np.zeros((2, 0)))
    if len(hot):
        found = _hot_pairs(docs, out, least).toArrow().sort_by("pair")  # at most SHARES, as each has such a share
        out.pairs = found.column("pair").to_numpy()
        out.paired = np.stack([found.column(c).to_numpy() for c in ("target", "background")])
    return out


def _filled(schema: pa.Schema, rows: int, /, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)


def _fields(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


_LISTS = {c: pa.list_(t) for c, t in {"row": pa.int16(), "text": pa.int64(), "n": pa.int64(), "target": pa.float64(), "background": pa.float64()}.items()}
_TOKENS = {c: pa.list_(t) for c, t in {"rare": pa.int64(), "other": pa.int64(), "word": pa.int16(), "near": pa.int16()}.items()}
#: Parts of the texts' sums, by ``gather`` (some thousand texts of one task).
_SUMS = _fields(gather=pa.int64(), **_LISTS)
#: Tokens by bucket, or a gather's own sums (kind 0).
_PACKED = _fields(bucket=pa.int32(), kind=pa.int8(), gather=pa.int64(), **_LISTS, **_TOKENS)


def _spark_schema(schema: pa.Schema) -> T.StructType:
    from pyspark.sql.pandas.types import from_arrow_schema

    return from_arrow_schema(schema)


def _packed(docs: DataFrame, frequent, buckets: int) -> DataFrame:
    """Every token once, packed by bucket: tokens of one word and context meet in one bucket.

    Kinds: 1 both frequent; 2 a rare word after a frequent one (or the start), or such a word at a
    text's end; 3 both rare; 4 a frequent word after a rare one. A row is negative (-1 - row) in a
    target text. Kind 0 has the texts, their words, and what their task could add up by itself:
    frequent contexts and hot pairs.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Frequent = frequent.value
        part, number = TaskContext.get().partitionId(), 0
        mass = known.mass(known.contexts)
        hot_loss = known.rarity(known.paired, known.prior(known.counts[:, known.pairs >> 16])) if len(known.pairs) else None
        held: list[tuple[np.ndarray, ...]] = []
        texts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal number
            gather = (part << 32) | number
            hashes, own, before, last, sign = map(np.concatenate, zip(*held, strict=True))
            n = np.concatenate(sizes)
            row = np.repeat(np.arange(len(n)), n)
            local = np.zeros((2, len(n)))
            near = before >= 0
            for m in range(2):
                local[m] += np.bincount(row[near], weights=mass[m][before[near]], minlength=len(n))
            both = near & (own >= 0)
            if hot_loss is not None:
                key = (own << 16) | before
                at = np.minimum(np.searchsorted(known.pairs, key), len(known.pairs) - 1)
                hot = both & (known.pairs[at] == key)
                for m in range(2):
                    local[m] += np.bincount(row[hot], weights=hot_loss[m][at[hot]], minlength=len(n))
                both &= ~hot
            context = np.empty_like(hashes)
            context[1:] = hashes[:-1]
            signed = np.where(sign, -1 - row, row).astype(np.int16)
            small = lambda x: x.astype(np.uint16).view(np.int16)
            ends = np.flatnonzero(last & (own < 0))
            behind = np.flatnonzero((own < 0) & near)
            far = np.flatnonzero((own < 0) & ~near)
            after = np.flatnonzero((own >= 0) & ~near)
            left = np.flatnonzero(both)
            two = np.concatenate((behind, ends))
            parts = [
                (1, (own[left] << 16) | before[left], {"word": small(own[left]), "near": small(before[left])}, left),
                (2, hashes[two], {"rare": hashes[two], "near": small(np.concatenate((before[behind], np.full(len(ends), LAST))))}, two),
                (3, hashes[far], {"rare": hashes[far], "other": context[far]}, far),
                (4, context[after], {"rare": context[after], "near": small(own[after])}, after),
            ]
            yield _filled(
                _PACKED, 1, bucket=pa.array([(part + number) % buckets], pa.int32()), kind=pa.array([0], pa.int8()), gather=pa.array([gather]),
                text=pa.array([np.concatenate(texts)], _LISTS["text"]), n=pa.array([n], _LISTS["n"]),
                target=pa.array([local[0]], _LISTS["target"]), background=pa.array([local[1]], _LISTS["background"]),
            )
            for kind, key, columns, at in parts:
                if not len(at):
                    continue
                bucket = (mix64(key.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
                order = np.lexsort((key, bucket))
                found, lists = listed(order, bucket, {**columns, "row": signed[at]})
                yield _filled(
                    _PACKED, len(found), bucket=pa.array(found), kind=pa.array(np.full(len(found), kind, np.int8)),
                    gather=pa.array(np.full(len(found), gather)), **lists,
                )
            number += 1
            for x in (held, texts, sizes):
                x.clear()

        for batch in batches:
            good = batch.column("_good").to_numpy(zero_copy_only=False)
            ids = batch.column("_text").to_numpy(zero_copy_only=False)
            for first, end, data, bounds in text_chunks(batch.column("text")):
                if sizes and (sum(map(len, sizes)) + end - first > ROWS or sum(len(h[0]) for h in held) > GATHER):
                    yield from emit()
                hashes, words = _hashed(data, bounds)
                own, before = known.ids(hashes, words)
                last = np.zeros(len(hashes), bool)
                last[_edges(words)[1]] = True
                held.append((hashes, own, before, last, np.repeat(good[first:end], np.diff(words))))
                texts.append(ids[first:end])
                sizes.append(np.diff(words))
        if sizes:
            yield from emit()

    return docs.select("_text", "text", "_good").mapInArrow(pack, _spark_schema(_PACKED))


def _bucket_losses(rows: pa.Table, known: _Frequent) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """(rows, (2, tokens) losses, signed text rows) of the tokens of one bucket, by kind."""
    kinds = {k: rows.filter(pc.equal(rows.column("kind"), k)) for k in range(1, 5)}
    prior = known.prior(known.counts)

    def paired(key: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each distinct key first stands, its place for every token, and its counts."""
        _, first, at = np.unique(key, return_index=True, return_inverse=True)
        return first, at, np.stack([np.bincount(at[good], minlength=len(first)), np.bincount(at, minlength=len(first))])

    for k in (1, 4):
        if kinds[k].num_rows:
            row = flat(kinds[k], "row")
            near = flat(kinds[k], "near").view(np.uint16).astype(np.int64)
            word = near if k == 4 else flat(kinds[k], "word").view(np.uint16).astype(np.int64)
            key = (word << 16) | near if k == 1 else mix64(near.view(np.uint64) * np.uint64(3) + flat(kinds[k], "rare").view(np.uint64))
            first, at, n = paired(key, row < 0)
            yield kinds[k], known.rarity(n, prior[:, word[first]])[:, at], row
    behind, far = kinds[2], kinds[3]
    if behind.num_rows or far.num_rows:
        word = np.concatenate([flat(behind, "rare"), flat(far, "rare")])
        row = np.concatenate([flat(behind, "row"), flat(far, "row")])
        near = flat(behind, "near").view(np.uint16).astype(np.uint64)
        last = np.concatenate((near == LAST, np.zeros(len(row) - len(near), bool)))
        context = np.concatenate((near, flat(far, "other").view(np.uint64)))
        good = row < 0
        distinct, of = np.unique(word, return_inverse=True)
        n, ends = (np.stack([np.bincount(of[x & good], minlength=len(distinct)), np.bincount(of[x], minlength=len(distinct))]) for x in (~last, last))
        mass, own = known.mass(n - ends), known.prior(n)
        losses = np.where(last, -1.0, 1.0) * mass[:, of]  # what follows a word is charged to the word itself
        token = np.flatnonzero(~last)
        first, at, n = paired(mix64(context[token] * np.uint64(3) + word[token].view(np.uint64)), good[token])
        losses[:, token] += known.rarity(n, own[:, of[token[first]]])[:, at]
        yield behind, losses[:, : len(near)], row[: len(near)]
        yield far, losses[:, len(near) :], row[len(near) :]


def _bucket_sums(packed: DataFrame, frequent) -> DataFrame:
    """Parts of the texts' sums (``_SUMS``), from the packed tokens of each bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Frequent = frequent.value
        for rows in runs(batches, "bucket"):
            yield from rows.filter(pc.equal(rows.column("kind"), 0)).select(_SUMS.names).to_batches()
            gathers = np.unique(rows.column("gather").to_numpy())
            places, losses = [], []
            for of, loss, row in _bucket_losses(rows, known):
                gather = np.searchsorted(gathers, of.column("gather").to_numpy())
                gather = np.repeat(gather, pc.list_value_length(of.column("row")).to_numpy())
                places.append((gather << 15) | np.where(row < 0, -1 - row, row))
                losses.append(loss)
            if not places:
                continue
            place, at = np.unique(np.concatenate(places), return_inverse=True)
            loss = np.concatenate(losses, axis=1)
            target, background = (np.bincount(at, weights=x, minlength=len(place)) for x in loss)
            found, lists = listed(
                np.arange(len(place)), place >> 15, {"row": (place & 0x7FFF).astype(np.int16), "target": target, "background": background}
            )
            yield _filled(_SUMS, len(found), gather=pa.array(gathers[found]), **lists)

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(add, _spark_schema(_SUMS))


def _text_sums(sums: DataFrame) -> DataFrame:
    """(_text, _n, _target, _background) of every text with words."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "gather"):
            own = pc.is_valid(rows.column("text"))
            texts, parts = rows.filter(own), rows.filter(pc.invert(own))
            n, row = flat(texts, "n"), flat(parts, "row")
            total = [flat(texts, c) + np.bincount(row, weights=flat(parts, c), minlength=len(n)) for c in ("target", "background")]
            some = n > 0
            columns = [x[some] for x in (flat(texts, "text"), n, *total)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["_text", "_n", "_target", "_background"])

    dealt = sums.repartition("gather").sortWithinPartitions("gather")
    return dealt.mapInArrow(add, "_text long, _n long, _target double, _background double")


def _score_whole(docs: DataFrame, good: DataFrame) -> DataFrame:
    """``docs`` with the four columns of :func:`score`, under models of all words and bigrams.

    Texts are told apart by 64-bit hashes, and so are words and bigrams. Rows of one text add
    up to the same means.
    """
    python_ready(docs.sparkSession)
    spark, text = docs.sparkSession, F.xxhash64("text").alias("_text")
    marked = docs.select("doc_id", text, "text").join(sized(good, 16).withColumn("_good", F.lit(True)), "doc_id", "left")
    marked = marked.select("_text", "text", F.coalesce("_good", F.lit(False)).alias("_good"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = _frequent(marked, partitions)
    means = marked.limit(0).select("_text", F.lit(0.0).alias("ce_target"), F.lit(0.0).alias("ce_background"))
    if known.size:
        frequent = spark.sparkContext.broadcast(known)
        sums = _text_sums(_bucket_sums(_packed(marked, frequent, max(partitions, known.total[1] >> 22)), frequent))
        added = sums.groupBy("_text").agg(*(F.sum(c).alias(c) for c in ("_n", "_target", "_background")))
        means = checkpointed(added.select("_text", *((F.col(f"_{c}") / F.col("_n")).alias(f"ce_{c}") for c in ("target", "background"))))
    n_tokens = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    scored = docs.withColumns({"_text": text, "n_tokens": n_tokens}).join(means, "_text", "left")
    return scored.withColumn("ce_difference", F.col("ce_target") - F.col("ce_background"))


def score(
    docs: DataFrame,
    labels: DataFrame,
    vocabulary: int | None = None,
    bigrams: int | None = None,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``docs`` with n_tokens, ce_target, ce_background and ce_difference (nats a token).

    ``docs`` needs doc_id and text; other columns pass through, but for those that bear one of
    the four names. Target texts are those of all documents labelled good, whole; both models
    count every document they are given, target documents included. A word is a run without
    ASCII white space, A-Z taken as a-z. ``vocabulary`` and ``bigrams``, given together, bound
    the models; then at most ``target_rows`` documents are target text.

    Null, empty and blank texts have no tokens and null entropies. Rows with a null doc_id are
    background only. Repeated rows count as often as they stand there and score alike. Without
    labels both models are smoothing alone for the target. An empty table gives an empty table.
    """
    new = ["n_tokens", "ce_target", "ce_background", "ce_difference"]
    if (vocabulary is None) != (bigrams is None):
        raise ValueError("vocabulary and bigrams are given together")
    given, docs = docs, folded(docs, ["doc_id", "text"], new)
    if vocabulary is None:
        good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
        return _score_whole(docs, good).select(*unfolded(given, ["doc_id", "text"], new), *new)
    models = docs.sparkSession.sparkContext.broadcast(fit(docs, labelled_good(labels, target_rows), vocabulary, bigrams))
    schema = T.StructType(docs.schema.fields + [T.StructField("n_tokens", T.LongType())] + [T.StructField(n, T.DoubleType()) for n in new[1:]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums = [np.zeros(0, np.int64)], [np.zeros((2, 0))]
            for _, _, data, bounds in text_chunks(batch.column("text")):
                start, stop, words = word_spans(data, bounds)
                losses = models.value.losses(SpanHash(data)(start, stop), words)
                sums.append(np.stack([reduce_rows(np.add, one, words, 0.0) for one in losses]))
                sizes.append(np.diff(words))
            n, total = np.concatenate(sizes), np.concatenate(sums, axis=1)
            none = n == 0
            means = total / np.maximum(n, 1)
            more = [pa.array(n)] + [pa.array(x, mask=none) for x in (means[0], means[1], means[0] - means[1])]
            yield pa.RecordBatch.from_arrays(batch.columns + more, batch.schema.names + new)

    return docs.mapInArrow(weigh, schema).select(*unfolded(given, ["doc_id", "text"], new), *new)
