"""From raw documents to packed training sequences: five stages over whole tables.

Each stage takes what the one before has kept, reads it back from Parquet in the shared
folder, and its decisions take effect there. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import circulant, importance, lines, packing, pfair
from tidemark.session import checkpointed, configure

NEAR_PERCENT, NEAR_AGREEMENT = 80, 0.63


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws; the others go."""
    scored = importance.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("selected").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each kind of line stays once; documents all of whose lines stand elsewhere go.

    ``n_chars`` is counted anew for the text that is left.
    """
    deduped = lines.dedup_lines(docs).where("n_kept is null or n_kept > 0 or n_lines = 0")
    return deduped.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest id.

    Documents are near copies from a Jaccard of ``NEAR_PERCENT`` hundredths on five-word
    shingles; op9's 85 is that query's own. The agreement asked for in large buckets lies 4.8
    deviations of a signature below it.
    """
    found = circulant.near_duplicates(docs, NEAR_PERCENT, NEAR_AGREEMENT).where("not kept").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out in files in the order of the mixture."""
    mixed = pfair.mix(docs).repartitionByRange("slot", "slot_part").sortWithinPartitions("slot", "slot_part")
    return mixed.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every token of every document stands in the training sequences.

    Sequences follow the order in which the mixture was laid out: files by their number, rows as
    they stand in a file. Documents that are not read from files are laid out first.
    """
    try:
        placed = docs.select("*", "_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        placed = checkpointed(mixing(spark, docs, sf_dir)).select("*", "_metadata.file_name", "_metadata.row_index")
    number = "cast(regexp_extract(file_name, '^part-([0-9]+)', 1) as bigint)"
    ordered = placed.select("doc_id", "text", F.expr(number).alias("_file"), F.col("row_index").cast("long").alias("_row"))
    return packing.pack_documents(ordered, public_tokenizers.path("byte_bpe_50k.json"), order=["_file", "_row"])


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing_stage),
]

#: Hashed models, signatures and the linear program have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
