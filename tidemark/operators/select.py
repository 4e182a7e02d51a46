"""One row per key, as aggregates (combined on the map side) instead of windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flipped(df: DataFrame, spec: str) -> Column:
    """A ranking entry as a column that sorts ascending with nulls last.

    ``"-score"`` means highest first; plain names mean lowest first.
    """
    name = spec.lstrip("-")
    col = F.col(name)
    kind = df.schema[name].dataType.typeName()
    if spec.startswith("-"):
        if kind in ("timestamp", "timestamp_ntz", "date"):
            col = -F.unix_micros(col.cast("timestamp"))
        elif kind in ("string", "binary", "boolean"):
            raise ValueError(f"cannot rank {name} ({kind}) downwards; derive a number first")
        else:
            col = -col
    return F.struct(F.col(name).isNull().alias("n"), col.alias("v"))


def best_per_key(df: DataFrame, key: Sequence[str], ranking: Sequence[str]) -> DataFrame:
    """The first row per key in ``ranking`` order (``"-col"`` = highest first, nulls last).

    Ties fall to the smallest of the remaining columns, so the result does not depend on
    the input's order. ``min`` over a struct combines on the map side: a hot key costs one
    row per task in the shuffle.
    """
    rank = F.struct(*[_flipped(df, r).alias(f"r{i}") for i, r in enumerate(ranking)])
    rest = [c for c in df.columns if c not in key]
    row = F.struct(rank.alias("rank"), F.struct(*rest).alias("row"))
    best = df.groupBy(*key).agg(F.min(row).alias("_best"))
    return best.select(*[F.col("_best.row")[c].alias(c) if c in rest else F.col(c) for c in df.columns])


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deterministic "any one row" per key."""
    return best_per_key(df, key, order)


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """The first ``n`` rows of a report (a top-n, kept per task before they meet)."""
    return df.orderBy(*order).limit(n)
