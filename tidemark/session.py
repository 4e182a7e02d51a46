"""Session settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


#: What open scratch scopes have written.
_scopes: list[list[str]] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    It is ``spark.checkpoint.dir`` of the session, or else the context's own checkpoint folder.
    Where neither is set, a temporary folder is made for a ``local`` master (tests, a laptop);
    on a cluster that is an error, as other machines could not read it.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if named is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return (named or sc.getCheckpointDir()).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder; reading it has no lineage.

    Written as Parquet rather than with ``DataFrame.checkpoint``: later steps often need a
    few of its columns only, and read just those. The files live as long as the folder, or
    until the :func:`scratch` scope ends in which they were written.
    """
    folder = shared_folder(df.sparkSession)
    if any(isinstance(f.dataType, T.NullType) for f in df.schema.fields):
        return df.checkpoint(eager=True)  # untyped nulls have no Parquet form
    path = f"{folder}/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what :func:`checkpointed` wrote inside it.

    Results that still read those tables must have been written by then.
    """
    _scopes.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for written in _scopes.pop():
            path = jvm.org.apache.hadoop.fs.Path(written)
            path.getFileSystem(conf).delete(path, True)
