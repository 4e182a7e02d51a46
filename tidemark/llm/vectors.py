"""Vectors as Spark rows and as bounded blocks that a task holds as one matrix."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.arrays import python_ready
from tidemark.session import checkpointed


def usable(table: DataFrame, zero: bool, most: float | None = None) -> DataFrame:
    """(vec_id, dim, vector) with vector as array<double>; one row for each vec_id. Written once.

    Left out are null ids, null or empty vectors, vectors that hold a null or a value that is
    not finite or exceeds ``most`` in size, and, unless ``zero``, vectors of zeros. Where rows
    share a vec_id the smallest vector counts.
    """
    python_ready(table.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= (most or 1.7e308)))
    some = F.lit(True) if zero else F.exists("vector", lambda x: x != 0)
    good = table.select(F.col("vec_id").cast("long"), vector.alias("vector")).where("vec_id is not null and size(vector) > 0")
    one = good.where(fine & some).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return checkpointed(one.select("vec_id", F.size("vector").alias("dim"), "vector"))


def blocks(rows: DataFrame, keys: list[str], most: int, prefix: str) -> DataFrame:
    """``keys`` and ``<prefix>_ids``, ``<prefix>_data``: groups of rows as matrices of bounded height.

    A group of any size is spread over as many blocks of about ``most`` rows as it needs.
    """
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / most).cast("long").alias("_parts"))
    same = sizes.select(*(F.col(k).alias(f"_{k}") for k in keys), "_parts")
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    dealt = rows.join(same, on).withColumn("_part", F.expr("pmod(xxhash64(vec_id), _parts)"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        data = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        out = {k: [pdf[k].iloc[0]] for k in keys}
        out |= {f"{prefix}_ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], f"{prefix}_data": [data.tobytes()]}
        return pd.DataFrame(out)

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, {prefix}_ids binary, {prefix}_data binary"
    return dealt.select(*keys, "_part", "vec_id", "vector").groupBy(*keys, "_part").applyInPandas(build, schema)


def matrix(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = np.frombuffer(ids, np.int64)
    return held, np.frombuffer(data, np.float64).reshape(len(held), -1)


def searched(
    pairs: DataFrame, search: Callable[..., tuple[np.ndarray, np.ndarray]], score: str
) -> DataFrame:
    """(query_id, vec_id, score) of what ``search`` finds for every query of every pair of blocks.

    ``search(q_id, q, ids, data, state)`` gets a query and a block; ``state`` is a dictionary of
    the task and the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, data = matrix(row["c_ids"], row["c_data"])
                q_ids, q_data = matrix(row["q_ids"], row["q_data"])
                state: dict = {}
                queries, found, scores = [], [], []
                for q_id, q in zip(q_ids.tolist(), q_data, strict=True):
                    near, value = search(q_id, q, ids, data, state)
                    queries.append(np.full(len(near), q_id))
                    found.append(near)
                    scores.append(value)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(queries)),
                        pa.array(np.concatenate(found)),
                        pa.array(np.concatenate(scores).astype(np.int64 if score == "long" else np.float64)),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return pairs.mapInArrow(run, f"query_id long, vec_id long, score {score}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
