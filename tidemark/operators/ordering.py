"""Global order without a single-task window.

``row_number() over (order by ...)`` sends the whole table to one task, and a window
partitioned by a key sends a hot key to one task. Here the table is range-partitioned by
its order (a hot leading key is split by the columns that follow it), the sorted
partitions are written to the checkpoint folder, and every later step works on
(partition, position in partition) plus one small row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed

_COPY = "_copy_no"
_POS = "_range_pos"
_PART = "_range_part"
ROWS_PER_TASK = 1_000_000


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def range_parts(df: DataFrame) -> int:
    """Range partitions for ``df``: at least the session's, and one per ``ROWS_PER_TASK`` rows."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // ROWS_PER_TASK))


def range_ordered(df: DataFrame, order: Sequence[Column | str], unique: bool = False) -> DataFrame:
    """``df`` in global order with ``_range_part`` and ``_range_pos`` (from 0).

    ``unique=True`` promises that ``order`` already tells all rows apart. Otherwise ties
    are broken by the row's own hash, and identical rows, which are interchangeable, by where
    they were read; so no large set of equal rows has to share a task. The number of range
    partitions follows the number of rows, as nothing splits them later.
    """
    keys = _columns(order)
    if not unique:
        payload = [F.col(f"`{c}`") for c in df.columns]
        df = df.withColumn(_COPY, F.monotonically_increasing_id())
        keys = keys + [F.xxhash64(*payload), F.col(_COPY)]
    parts = range_parts(df)
    placed = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_placed", F.monotonically_increasing_id())
        .drop(_COPY)
    )
    # The id is (partition << 33) + row. Range bounds are sampled, so the placement is
    # fixed by the checkpoint before anything is derived from it.
    return (
        checkpointed(placed)
        .withColumn(_PART, F.shiftright("_placed", 33).cast("int"))
        .withColumn(_POS, F.col("_placed").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_placed")
    )


def _part_offsets(placed: DataFrame) -> DataFrame:
    """One row per range partition: rows before it, and rows in total."""
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    # The window sees one row per range partition, not the table.
    before = Window.partitionBy(F.lit(0)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    return sizes.select(
        _PART,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )


def global_rank(
    df: DataFrame, order: Sequence[Column | str], name: str = "rnk", unique: bool = False, total: str | None = None
) -> DataFrame:
    """Rank from 1 in the global order; optionally the total number of rows too."""
    placed = range_ordered(df, order, unique)
    # Safe to broadcast: one row of three numbers per range partition.
    ranked = placed.join(F.broadcast(_part_offsets(placed)), _PART)
    out = ranked.withColumn(name, F.col("_before") + F.col(_POS) + 1)
    if total is not None:
        out = out.withColumn(total, F.col("_total"))
    return out.drop(_PART, _POS, "_before", "_total")


def rank_slice(df: DataFrame, order: Sequence[Column | str], start: int, stop: int, unique: bool = False) -> DataFrame:
    """Rows whose rank lies between ``start`` and ``stop``, both included, with ``rnk``."""
    return global_rank(df, order, "rnk", unique).where(F.col("rnk").between(start, stop))


def chunk_by_rank(
    df: DataFrame, order: Sequence[Column | str], size: int = 500, name: str = "chunk", unique: bool = False
) -> DataFrame:
    """Every row gets a chunk number from 0; all chunks but the last hold ``size`` rows."""
    ranked = global_rank(df, order, "_rank", unique)
    return ranked.withColumn(name, F.expr(f"(_rank - 1) div {int(size)}")).drop("_rank")


def ntile_batch(
    df: DataFrame,
    order: Sequence[Column | str],
    n: int = 10,
    tile: int | None = None,
    name: str = "tile",
    unique: bool = False,
) -> DataFrame:
    """NTILE(n) over the global order; ``tile`` keeps one batch."""
    ranked = global_rank(df, order, "_rank", unique, total="_rows")
    q, r = f"(_rows div {int(n)})", f"(_rows % {int(n)})"
    wide = f"{r} * ({q} + 1)"
    tiles = F.expr(
        f"int(case when _rank <= {wide} then (_rank - 1) div ({q} + 1) + 1"
        f" else {r} + (_rank - {wide} - 1) div greatest({q}, 1) + 1 end)"
    )
    out = ranked.withColumn(name, tiles).drop("_rank", "_rows")
    return out if tile is None else out.where(F.col(name) == tile)


def lag_in_key(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    column: str,
    name: str,
    unique: bool = False,
) -> DataFrame:
    """Previous value of ``column`` within ``key``, null on a key's first row.

    Rows are looked at by range partition, not by key: inside a partition by a window, and
    for its first row by the last row of the partition before it.
    """
    placed = range_ordered(df, [*key, *order], unique)
    inside = Window.partitionBy(_PART).orderBy(_POS)
    here = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.col(column).alias("v"))
    lasts = placed.groupBy(_PART).agg(F.max_by(here, F.col(_POS)).alias("_last"))
    ordered = Window.partitionBy(F.lit(0)).orderBy(_PART)
    # One row per non-empty range partition, so the window and the broadcast stay small.
    edges = lasts.select(_PART, F.lag("_last").over(ordered).alias("_edge"))
    stepped = placed.withColumn("_prev", F.lag(here).over(inside)).join(F.broadcast(edges), _PART)
    prev = F.coalesce(F.col("_prev"), F.col("_edge"))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & prev[f"k{i}"].eqNullSafe(F.col(k))
    return stepped.withColumn(name, F.when(same, prev["v"])).drop(_PART, _POS, "_prev", "_edge")
