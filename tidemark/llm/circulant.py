"""Near-duplicate documents by circulant MinHash.

Positions are 32-bit words. One permutation scatters a document's shingles over them; a
second one, circularly shifted by 0, 1, 2, ... positions, gives each shift's minimum: the whole
signature comes from two permutations. Bands of coordinates are buckets; pairs that share a
bucket are confirmed on their whole shingle sets; components of confirmed links are groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import linking
from tidemark.llm.arrays import mix32, mix64, reduce_rows, python_ready, text_chunks, word_shingles
from tidemark.session import checkpointed

BANDS, ROWS = 26, 5
COORDINATES = BANDS * ROWS
NOTHING = np.uint32(0xFFFFFFFF)


def signatures(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One row of ``COORDINATES`` minima for each row's set of shingle hashes."""
    scattered = (mix64(values ^ np.uint64(0x5BD1E995)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(rows) - 1, COORDINATES), np.uint32)
    for shift in range(COORDINATES):
        out[:, shift] = reduce_rows(np.minimum, mix32(scattered - np.uint32(shift)), rows, NOTHING)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; different bands never share keys but by chance."""
    keys = np.zeros((len(signature), BANDS), np.uint64)
    parts = signature.reshape(len(signature), BANDS, ROWS)
    for r in range(ROWS):
        keys = mix64(keys * np.uint64(31) + parts[:, :, r])
    return mix64(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, print_a, print_b, signature) of every row, in one pass.

    The two fingerprints are sums of differently mixed shingles, so equal sets agree in both.
    """
    python_ready(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, bounds in text_chunks(batch.column("text")):
                values, rows = word_shingles(data, bounds)
                prints = [
                    reduce_rows(np.add, mix64(values + np.uint64(salt)), rows, 0).view(np.int64) for salt in (11, 0xABCDEF)
                ]
                sig = signatures(values, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, end - first),
                        pa.array(np.diff(rows)),
                        *map(pa.array, prints),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "print_a", "print_b", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        describe, "doc_id long, n_shingles long, print_a long, print_b long, signature binary"
    )


def buckets(items: DataFrame) -> DataFrame:
    """(band, key, id) for each band of each item (id, signature)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(ids))),
                    pa.array(band_keys(sig).ravel()),
                    pa.array(np.repeat(ids, BANDS)),
                ],
                ["band", "key", "id"],
            )

    return items.select("id", "signature").mapInArrow(split, "band int, key long, id long")


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted shingle set of every text of a column."""
    out = []
    for _, _, data, bounds in text_chunks(column):
        values, rows = word_shingles(data, bounds)
        out.extend(values[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True))
    return out


def near_duplicates(docs: DataFrame, percent: int = 85, least_agreement: float = 0.70) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text, ...).

    Shingles are five words, A-Z taken as a-z; with fewer words the whole sequence is the one
    shingle. Rows are linked if ``100 * intersection >= percent * union``. Banding misses a link
    at 0.85 with a chance of 3e-7; ``least_agreement`` of the signature, at which pairs inside
    large buckets are still confirmed, lies 4.8 deviations below it.

    Null, empty and blank texts have no shingles and no links: they are their own component.
    Equal sets are one class, however many rows have them. Rows that share a doc_id are one
    document, linked through each of its texts, and share ``kept``. A null doc_id cannot be
    linked to: its component is null and it is kept. An empty table gives an empty table.
    """
    found = checkpointed(features(docs))
    prints = ["print_a", "print_b", "n_shingles"]
    sets = found.where("n_shingles > 0 and doc_id is not null")
    classes = sets.groupBy(*prints).agg(F.min("doc_id").alias("id"))
    classes = checkpointed(classes)
    # a document with several texts ties their classes together
    several = sets.groupBy("doc_id").agg(F.min("print_a").alias("_a"), F.max("print_a").alias("_b")).where("_a <> _b")
    member = sets.join(several.select("doc_id"), "doc_id").join(classes, prints)
    same_id = member.select(F.col("doc_id").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()

    items = (
        sets.join(classes.withColumnRenamed("id", "doc_id"), [*prints, "doc_id"])
        .groupBy(F.col("doc_id").alias("id"), *prints)
        .agg(F.min("signature").alias("signature"))
    )
    items = checkpointed(items)
    shared = linking.shared_buckets(buckets(items))
    involved = linking.sized(shared.select("id").distinct(), 32)
    texts = checkpointed(
        docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(involved, "id").dropDuplicates(["id", "text"])
    )
    links = linking.verified(linking.pivot_pairs(shared), texts, shingle_sets, percent)
    parts = linking.components(links)

    whole = texts.join(items.select("id", F.col("n_shingles").alias("size"), "signature"), "id")
    members = linking.open_members(shared, parts, whole)

    def signature(block: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(block.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)

    more = linking.cross_links(members, signature, shingle_sets, BANDS, ROWS, least_agreement, percent)
    groups = linking.components(links.union(more).union(same_id))
    classed = classes.join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        *prints, F.coalesce("component", "id").alias("_component")
    )
    named = found.drop("signature").join(classed, prints, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
