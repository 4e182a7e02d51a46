"""Token ids of documents in shard files, each document a zstandard frame with one shared dictionary.

Texts are encoded by a ``tokenizers`` file and each document's ids, with ``end_id`` after
them, are serialised as little-endian unsigned 32-bit integers. A zstandard dictionary is
trained on such arrays of a bounded sample (``sample_docs`` documents chosen by a hash of
doc_id and text, at most ``sample_bytes``), written once beside the shards, and every
document is compressed by itself with it, so any one document can be read alone.

Documents are ranged by (doc_id, text) over the tasks, and each task writes one shard in that
order (shard numbers follow the ranges). A shard file is::

    MAGIC | frame 0 | frame 1 | ... | footer
    footer = doc_id int64[n] | has_id uint8[n] | local start uint64[n] | n_tokens uint64[n]
             | frame offset uint64[n + 1] | dictionary xxh64 uint64 | n uint64 | footer offset uint64 | MAGIC

A task writes its shard under a name of its own attempt and renames it when whole, so a lost
or repeated task leaves one complete file. Readers check the dictionary's hash.

Defined cases: a null text is empty (its ids are just ``end_id``); a null doc_id is stored
with has_id = 0 and comes first; repeated doc_ids keep one frame each, ordered by text; an
empty table writes no shard and reads back no rows; other columns are not carried.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import python_ready
from tidemark.llm.tokens import encoder
from tidemark.session import checkpointed, shared_folder

MAGIC = b"TMIDS\x00\x01\x00"
END_ID = 2
SAMPLE_DOCS = 4000
SAMPLE_BYTES = 32 << 20
DICT_BYTES = 1 << 16
LEVEL = 3
DICTIONARY = "dictionary.zdict"


def _fs(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    if folder.startswith("/"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def serialised(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> list[bytes]:
    """Each row's ids with ``end_id`` appended, as little-endian uint32 bytes."""
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        row = np.empty(b - a + 1, "<u4")
        row[:-1], row[-1] = ids[a:b], end_id
        out.append(row.tobytes())
    return out


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bounds = encoder(tokenizer).encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(serialised(ids, bounds, end_id), pa.binary())], names=["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids binary")


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> bytes:
    """A dictionary trained on the id arrays of a bounded sample; empty where there is too little to learn from."""
    sample = docs.orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLE_DOCS)
    chosen, held = [], 0
    for row in _encoded(sample, tokenizer, end_id).toLocalIterator():
        if held + len(row.ids) > SAMPLE_BYTES:
            break
        chosen.append(bytes(row.ids))
        held += len(row.ids)
    if len(chosen) < 8 or held < 4 * DICT_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, chosen).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes ``docs`` as shard files into ``folder``; returns the written index (shard, n, tokens)."""
    spark = docs.sparkSession
    python_ready(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = train_dictionary(docs, tokenizer, end_id)
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{DICTIONARY}") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICT_BYTES

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        fs, root = _fs(folder)
        zdict = shared.value
        compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(zdict) if zdict else None
        )
        temporary = f"{root}/shard-{shard:05d}.{context.attemptNumber()}-{uuid.uuid4().hex}.part"
        ids_, has, sizes, offsets = [], [], [], [len(MAGIC)]
        with fs.open_output_stream(temporary) as out:
            out.write(MAGIC)
            for batch in batches:
                tokens, bounds = encoder(tokenizer).encode(batch.column("text"))
                for doc_id, raw in zip(batch.column("doc_id").to_pylist(), serialised(tokens, bounds, end_id), strict=True):
                    frame = compressor.compress(raw)
                    out.write(frame)
                    ids_.append(doc_id if doc_id is not None else 0)
                    has.append(doc_id is not None)
                    sizes.append(len(raw) // 4)
                    offsets.append(offsets[-1] + len(frame))
            if sizes:
                out.write(_footer(ids_, has, sizes, offsets, xxhash.xxh64_intdigest(zdict)))
        if not sizes:
            fs.delete_file(temporary)
            return
        fs.move(temporary, f"{root}/shard-{shard:05d}.tmid")
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([len(sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())],
            names=["shard", "n_docs", "n_tokens"],
        )

    ordered = docs.orderBy(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    return checkpointed(ordered.mapInArrow(write, "shard int, n_docs long, n_tokens long"))


def _footer(doc_ids, has, sizes, offsets, dict_hash: int) -> bytes:
    sizes = np.asarray(sizes, "<u8")
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype("<u8")
    body = b"".join(
        [
            np.asarray(doc_ids, "<i8").tobytes(),
            np.asarray(has, "u1").tobytes(),
            starts.tobytes(),
            sizes.tobytes(),
            np.asarray(offsets, "<u8").tobytes(),
        ]
    )
    return body + struct.pack("<QQQ", dict_hash, len(sizes), offsets[-1]) + MAGIC


class Shard:
    """One shard file, opened for reading a document at a time."""

    def __init__(self, fs: pafs.FileSystem, path: str, dictionary: bytes):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(24 + len(MAGIC), size - 24 - len(MAGIC))
        if tail[24:] != MAGIC:
            raise ValueError(f"{path} is not a whole shard")
        dict_hash, n, begins = struct.unpack("<QQQ", tail[:24])
        if dict_hash != xxhash.xxh64_intdigest(dictionary):
            raise ValueError(f"{path} was written with another dictionary")
        footer = self.file.read_at(size - 24 - len(MAGIC) - begins, begins)  # from its offset to the tail
        at = 0
        self.doc_ids = np.frombuffer(footer, "<i8", n, at)
        at += 8 * n
        self.has_id = np.frombuffer(footer, "u1", n, at).astype(bool)
        at += n
        self.starts = np.frombuffer(footer, "<u8", n, at)
        at += 8 * n
        self.sizes = np.frombuffer(footer, "<u8", n, at)
        at += 8 * n
        self.offsets = np.frombuffer(footer, "<u8", n + 1, at)
        self.decompressor = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )

    def __len__(self) -> int:
        return len(self.sizes)

    def ids(self, i: int) -> bytes:
        """The serialised ids of the ``i``-th document."""
        a, b = int(self.offsets[i]), int(self.offsets[i + 1])
        return self.decompressor.decompress(self.file.read_at(b - a, a), max_output_size=4 * int(self.sizes[i]))

    def find(self, doc_id: int) -> list[int]:
        """Places of the documents with ``doc_id`` (doc_ids are ascending, null ones first)."""
        first = int(np.argmax(self.has_id)) if self.has_id.any() else len(self)
        lo = first + int(np.searchsorted(self.doc_ids[first:], doc_id, "left"))
        hi = first + int(np.searchsorted(self.doc_ids[first:], doc_id, "right"))
        return list(range(lo, hi))


def read_document(folder: str, shard: int, doc_id: int) -> list[np.ndarray]:
    """Short-document access: the ids of ``doc_id`` in one shard, read from its frame alone."""
    fs, root = _fs(folder)
    with fs.open_input_file(f"{root}/{DICTIONARY}") as f:
        dictionary = f.read()
    shard_file = Shard(fs, f"{root}/shard-{shard:05d}.tmid", dictionary)
    return [np.frombuffer(shard_file.ids(i), "<u4") for i in shard_file.find(doc_id)]


def read_shards(spark, folder: str, written: DataFrame) -> DataFrame:
    """Every document of the shards, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    shards = written.select("shard", "n_tokens")
    bases = shards.select(
        "shard", (F.sum("n_tokens").over(Window.orderBy("shard")) - F.col("n_tokens")).alias("base")
    )  # one row a shard

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _fs(folder)
        with fs.open_input_file(f"{root}/{DICTIONARY}") as f:
            dictionary = f.read()
        for batch in batches:
            for shard, base in zip(batch.column("shard").to_pylist(), batch.column("base").to_pylist(), strict=True):
                shard_file = Shard(fs, f"{root}/shard-{shard:05d}.tmid", dictionary)
                crcs, counts = [], []
                for i in range(len(shard_file)):
                    raw = shard_file.ids(i)
                    crcs.append(zlib.crc32(raw))
                    counts.append(len(raw) // 4)
                doc_ids = pa.array(shard_file.doc_ids.tolist(), pa.int64(), mask=~shard_file.has_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids,
                        pa.array(base + shard_file.starts.astype(np.int64), pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = bases.repartition(F.col("shard"))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``docs`` written as shard files in the shared folder and read back from them."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-shards-{uuid.uuid4().hex}"
    written = write_shards(docs, folder, tokenizer, end_id)
    return read_shards(spark, folder, written)
