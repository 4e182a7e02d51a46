"""Unions, unpivots and nesting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.operators.ordering import global_rank


@dataclass(frozen=True)
class Flag:
    """A product flag with its label, code and (where they exist) its own date columns."""

    column: str
    label: str
    code: int
    date_from: str | None = None
    date_to: str | None = None


def union_positional(a: DataFrame, b: DataFrame, names: Sequence[str]) -> DataFrame:
    """UNION ALL by position; the result has ``names``."""
    return a.toDF(*names).union(b.toDF(*names))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), frames)


def unpivot_flags(
    df: DataFrame,
    flags: Sequence[Flag],
    keep: Sequence[str],
    label: str = "service_desc",
    code: str = "service_cd",
) -> DataFrame:
    """One row per set flag (value 1), in one pass over the table.

    A date column a flag names but the table lacks counts as null.
    """
    def dated(name: str | None):
        present = name is not None and name in df.columns
        return (F.col(name) if present else F.lit(None)).cast("timestamp_ntz")

    options = F.array(
        *[
            F.when(
                F.col(f.column) == 1,
                F.struct(
                    dated(f.date_from).alias("date_from"),
                    dated(f.date_to).alias("date_to"),
                    F.lit(f.label).alias(label),
                    F.lit(f.code).alias(code),
                ),
            )
            for f in flags
        ]
    )
    return df.select(*keep, F.inline(F.array_compact(options)))


def nest_lines(
    lines: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    out: str = "lines",
    page_size: int | None = None,
    max_lines: int = 1_000_000,
) -> DataFrame:
    """Lines nested per key as an array ordered by ``order``, then by the line itself.

    One row per key, whatever its size. A key with more than ``max_lines`` lines is an error
    that names it: such a document does not fit a row, keep it flat. With ``page_size`` every
    key is cut into pages of that many lines instead, numbered from 0 in ``page_no``; pages
    follow the global order, so a key of any size is spread over many tasks.
    """
    line = F.struct(*fields).alias("line")
    if page_size is None:
        sizes = lines.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
        too_long = sizes.where(F.col("_n") > max_lines).limit(1).collect()
        if too_long:
            raise ValueError(f"{tuple(too_long[0])[:-1]} has {too_long[0]['_n']} lines, more than {max_lines}")
        nested = lines.groupBy(*key).agg(
            F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("by"), line))).alias("_sorted")
        )
        return nested.select(*key, F.transform("_sorted", lambda s: s["line"]).alias(out))
    ranked = global_rank(lines, [*key, *order, *fields], "_rank")
    firsts = ranked.groupBy(*key).agg(F.min("_rank").alias("_first"))
    placed = null_safe_join(ranked, firsts, key, "inner")
    paged = placed.withColumn("page_no", F.expr(f"int((_rank - _first) div {int(page_size)})"))
    pages = paged.groupBy(*key, "page_no").agg(F.sort_array(F.collect_list(F.struct("_rank", line))).alias("_sorted"))
    return pages.select(*key, "page_no", F.transform("_sorted", lambda s: s["line"]).alias(out))
