"""Mixing sources to target weights by Pfair scheduling, with DataFrame operations only.

A source's texts are cut into blocks of about equal bytes. With a weight of w the k-th block of
a source (from 0) is released at k / w and due at (k + 1) / w; in every slot the block that is
released and due first is served. Any span from the start then holds each source's share to
within less than one block. With whole-number tickets the schedule repeats, so one period is
laid out here and every block finds its slot by arithmetic.

When a source has no blocks left, the others go on among themselves: a new phase begins, in
which the weights of those left are scaled up and deviations count anew.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.columns import folded, unfolded
from tidemark.session import checkpointed

BLOCK_BYTES = 64 << 10
TICKETS = 1000
RUN_ROWS = 100_000
MOST_SOURCES = 1000


def period(tickets: list[int]) -> list[list[int]]:
    """For each source the slots of its blocks in one period of ``sum(tickets)`` slots.

    Earliest deadline first among released blocks; ties go to the smaller deadline numerator,
    then to the earlier source.
    """
    total = sum(tickets)
    released: list[tuple[int, int, int]] = []
    coming = [(0, s, 0) for s, n in enumerate(tickets) if n]
    heapq.heapify(coming)
    slots: list[list[int]] = [[] for _ in tickets]
    for slot in range(total):
        while coming and coming[0][0] <= slot:
            _, s, k = heapq.heappop(coming)
            heapq.heappush(released, (-(-(k + 1) * total // tickets[s]), s, k))
        _, s, k = heapq.heappop(released)
        slots[s].append(slot)
        if k + 1 < tickets[s]:
            heapq.heappush(coming, ((k + 1) * total // tickets[s], s, k + 1))
    return slots


def whole_tickets(weights: list[float], total: int) -> list[int]:
    """Whole numbers in proportion to the weights, at least one each (largest remainders)."""
    total = max(total, len(weights))
    spare = total - len(weights)
    exact = [w / sum(weights) * total - 1 for w in weights]
    positive = [max(0.0, x) for x in exact]
    scale = spare / sum(positive) if sum(positive) else 0.0
    given = [int(x * scale) for x in positive]
    order = sorted(range(len(weights)), key=lambda s: (given[s] - positive[s] * scale, s))
    for s in order[: spare - sum(given)]:
        given[s] += 1
    return [g + 1 for g in given]


def phases(blocks: list[int], weights: list[float], tickets: int = TICKETS) -> list[tuple]:
    """Rows of (source, first block, end block, period, quota, slot base, k, slot in the period).

    Blocks ``first <= b < end`` of a source are served in a phase; its k-th block of a period
    is served at that slot. A phase ends with the slot in which a source gets its last block.
    """
    served, base, rows = [0] * len(blocks), 0, []
    while True:
        active = [s for s, n in enumerate(blocks) if served[s] < n]
        if not active:
            return rows
        given = whole_tickets([weights[s] for s in active], tickets)
        shared = gcd(*given)
        given = [g // shared for g in given]
        length, slots = sum(given), period(given)
        last = []
        for i, s in enumerate(active):
            left = blocks[s] - served[s] - 1
            last.append(left // given[i] * length + slots[i][left % given[i]])
        end = min(last) + 1
        for i, s in enumerate(active):
            whole, rest = divmod(end, length)
            got = whole * given[i] + sum(x < rest for x in slots[i])
            if got:
                rows += [(s, served[s], served[s] + got, length, given[i], base, k, x) for k, x in enumerate(slots[i])]
            served[s] += got
        base += end


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    alpha: float = 0.7,
    block_bytes: int = BLOCK_BYTES,
    tickets: int = TICKETS,
) -> DataFrame:
    """``docs`` with ``block``, ``slot`` and ``slot_part``: reading by slot gives the mixture.

    ``docs`` needs doc_id, text and source; other columns pass through, but for those that bear
    one of the three names. ``weights`` gives a positive target share to each source (any scale,
    1 where a source is missing); without it a source weighs its bytes to the power ``alpha``.
    Shares are rounded to whole tickets of about ``tickets`` a period, at least one each. A
    block is ``block_bytes`` of a source; a document belongs to the block it begins in, so one
    that is longer leaves the following blocks to itself. Within a block ``slot_part`` is the
    byte at which a document begins.

    Every row stays. Sources are named by value, null is a source too; a mixture of more than
    ``MOST_SOURCES`` is refused, so that the laid-out periods have a bound. Null and empty texts count one byte, so they too
    have places. Repeated rows follow each other. An empty table gives an empty table.
    """
    given, needed, new = docs, ["doc_id", "text", "source"], ["block", "slot", "slot_part"]
    docs = folded(given, needed, new)
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    narrow = docs.withColumn("_size", size.cast("long"))
    totals = {r[0]: (r[1], r[2]) for r in narrow.groupBy("source").agg(F.sum("_size"), F.count("*")).collect()}
    names = sorted(totals, key=lambda s: (s is not None, s))
    share = [float(weights.get(s, 1.0)) if weights is not None else totals[s][0] ** alpha for s in names]
    if len(names) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    if any(w <= 0 for w in share):
        raise ValueError("weights must be positive")
    spark = docs.sparkSession

    # where a document begins in its source: runs of bounded size, then within a run
    runs = 8 + max((n for _, n in totals.values()), default=0) // RUN_ROWS
    dealt = narrow.withColumn("_order", F.xxhash64("doc_id", "text")).withColumn("_run", F.expr(f"pmod(_order, {runs})"))
    sums = checkpointed(dealt.groupBy("source", "_run").agg(F.sum("_size").alias("_sum")))
    before = sums.select(
        F.col("source").alias("_name"),
        F.col("_run").alias("_part"),
        (F.sum("_sum").over(Window.partitionBy("source").orderBy("_run")) - F.col("_sum")).alias("_before"),
    )
    within = Window.partitionBy("source", "_run").orderBy("_order", "doc_id")
    begun = dealt.withColumn("_in_run", F.sum("_size").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    same = F.col("source").eqNullSafe(F.col("_name")) & (F.col("_run") == F.col("_part"))
    placed = begun.join(before, same).withColumn("_byte", F.coalesce("_in_run", F.lit(0)) + F.col("_before"))
    placed = placed.withColumn("block", F.expr(f"_byte div {block_bytes}")).withColumn(
        "slot_part", F.expr(f"_byte % {block_bytes}")
    )

    blocks = [-(-totals[s][0] // block_bytes) for s in names]
    laid = [(names[r[0]], *r[1:]) for r in phases(blocks, share, tickets)]
    plan = spark.createDataFrame(
        laid, "_of string, _from long, _to long, _length long, _quota long, _base long, _k long, _at long"
    ).withColumn("_of", F.col("_of").cast(docs.schema["source"].dataType))
    # one array of slots for each source and phase
    plan = plan.groupBy("_of", "_from", "_to", "_length", "_quota", "_base").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_k", "_at"))), lambda x: x["_at"]).alias("_slots")
    )
    served = F.col("source").eqNullSafe(F.col("_of")) & (F.col("block") >= F.col("_from")) & (F.col("block") < F.col("_to"))
    k = F.col("block") - F.col("_from")
    slot = F.col("_base") + F.expr("(block - _from) div _quota") * F.col("_length")
    mixed = placed.join(F.broadcast(plan), served).withColumn(
        "slot", slot + F.get("_slots", (k % F.col("_quota")).cast("int"))
    )
    return mixed.select(*unfolded(given, needed, new), "block", "slot", "slot_part")
