"""Registry and table access shared by the query modules."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads ``orders.parquet`` of the chosen scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession) -> str:
    """A new folder of the session's shared folder, for queries that write and read back."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`; ``sql`` is the same result in ANSI SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
