"""Quality classifier by importance resampling.

Two generative models over hashed word unigrams and bigrams are counted: one over target
texts (a bounded sample of documents labelled good), one over all texts. A document's log
importance weight is the sum over its n-grams of the log ratio of the two models; divided by
its length (plus ``SHORT``), it says how much the text looks like the target. Gumbel top-k then
draws the sample: every document's weight gets Gumbel noise of its own, and the k largest stay.
``k`` is the number of documents at or above the weight that ``keep`` of the held-out good
documents reach; these are labelled good and were not used to count the target model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import SpanHash, mix64, reduce_rows, python_ready, text_chunks, word_spans
from tidemark.llm.columns import folded, unfolded
from tidemark.llm.select import at_least_kth
from tidemark.session import checkpointed

BUCKETS = 1 << 16
SMOOTHING = 10.0
TARGET_ROWS = 100_000
SHORT = 50
LEAST = 20


def ngram_buckets(data: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every unigram and bigram of each row, and the row bounds.

    A-Z counts as a-z. A row of w words has w unigrams and w - 1 bigrams.
    """
    start, end, words = word_spans(data, bounds)
    one = SpanHash(data)(start, end)
    two = mix64(one[:-1] * np.uint64(3) + one[1:])
    row = np.repeat(np.arange(len(words) - 1), np.diff(words))
    same = row[:-1] == row[1:]
    rows = np.concatenate((row, row[:-1][same]))
    order = np.argsort(rows, kind="stable")
    values = (np.concatenate((one, two[same])) % np.uint64(buckets)).astype(np.int64)[order]
    return values, np.searchsorted(rows[order], np.arange(len(words)))


def labelled_good(labels: DataFrame, rows: int = TARGET_ROWS) -> np.ndarray:
    """Ids of at most ``rows`` documents labelled good, in the order of a hash of the id."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).toPandas()["doc_id"].to_numpy(np.int64)


def log_ratios(docs: DataFrame, target: np.ndarray, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of target and raw model for each bucket, counted over all documents.

    Both are smoothed with ``smoothing`` pseudo-counts a bucket, at the target model's size, so
    rare buckets lean to ratio one.
    """
    python_ready(docs.sparkSession)
    wanted = docs.sparkSession.sparkContext.broadcast(target)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            ids = batch.column("doc_id")
            is_target = np.isin(pc.fill_null(ids, -1).to_numpy(zero_copy_only=False), wanted.value)
            is_target &= pc.is_valid(ids).to_numpy(zero_copy_only=False)
            for first, end, data, bounds in text_chunks(batch.column("text")):
                values, rows = ngram_buckets(data, bounds, buckets)
                raw += np.bincount(values, minlength=buckets)
                chosen = np.repeat(is_target[first:end], np.diff(rows))
                good += np.bincount(values[chosen], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(good[used])], ["bucket", "raw", "good"])

    counted = docs.select("doc_id", "text").mapInArrow(count, "bucket long, raw long, good long")
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas()
    raw, good = np.zeros(buckets), np.zeros(buckets)
    raw[sums["bucket"]], good[sums["bucket"]] = sums["raw"], sums["good"]
    expected = raw * (good.sum() / max(1, raw.sum()))
    return np.log((good + smoothing) / (expected + smoothing))


def weighed(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``docs`` with ``_ngrams`` and ``_log_weight`` (0 without words)."""
    python_ready(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = T.StructType(docs.schema.fields + [T.StructField("_ngrams", T.LongType()), T.StructField("_log_weight", T.DoubleType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, data, bounds in text_chunks(batch.column("text")):
                values, rows = ngram_buckets(data, bounds, len(table.value))
                sums.append(reduce_rows(np.add, table.value[values], rows, 0.0))  # the same for equal texts
                sizes.append(np.diff(rows))
            more = [pa.array(np.concatenate(sizes), pa.int64()), pa.array(np.concatenate(sums), pa.float64())]
            yield pa.RecordBatch.from_arrays(batch.columns + more, batch.schema.names + ["_ngrams", "_log_weight"])

    return docs.mapInArrow(weigh, schema)


def gumbel(seed: int, *columns: str) -> Column:
    """Standard Gumbel noise that depends on the columns and the seed only."""
    part = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double")
    return -F.log(-F.log((part + 0.5) / float(1 << 53)))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep: float = 0.998,
    sharpness: float = 1000.0,
    seed: int = 7,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``docs`` with ``n_ngrams``, ``log_weight``, ``score`` and ``selected``.

    ``docs`` needs doc_id and text; other columns pass through, but for those that bear one of
    the four names, which the new ones replace. ``sharpness`` scales the weight a n-gram
    against the noise. At most ``target_rows`` labelled rows are used, three of four for the
    model and the fourth to set ``k``.

    Null and empty texts have weight 0 and take part like others. Repeated rows have equal
    scores and share one fate; ties at the cut all stay. Rows with a null doc_id are scored by
    their text. With fewer than ``LEAST`` held-out documents no cut can be set and all
    documents stay. An empty table gives an empty table.
    """
    given, new = docs, ["n_ngrams", "log_weight", "score", "selected"]
    docs = folded(given, ["doc_id", "text"], new)
    good = labelled_good(labels, target_rows)
    held = np.arange(len(good)) % 4 == 3
    scored = weighed(docs, log_ratios(docs, good[~held])).withColumn(
        "_score", F.lit(sharpness) * F.col("_log_weight") / (F.col("_ngrams") + SHORT) + gumbel(seed, "doc_id", "text")
    )
    narrow = checkpointed(
        scored.select("doc_id", (F.col("_log_weight") / (F.col("_ngrams") + SHORT)).alias("_weight"), "_score")
    )
    chosen = docs.sparkSession.createDataFrame([(int(i),) for i in good[held]], "doc_id long")
    base = narrow.join(F.broadcast(chosen), "doc_id").where("_weight <> 0")  # at most target_rows / 4 ids
    floor, n = base.agg(F.percentile("_weight", F.lit(1 - keep)), F.count("*")).first()
    cut = -math.inf
    if n >= LEAST:
        cut = at_least_kth(narrow.select("_score"), narrow.where(F.col("_weight") >= floor).count())
    return scored.select(
        *unfolded(given, ["doc_id", "text"], new),
        F.col("_ngrams").alias("n_ngrams"),
        F.col("_log_weight").alias("log_weight"),
        F.col("_score").alias("score"),
        (F.col("_score") >= F.lit(cut)).alias("selected"),
    )
