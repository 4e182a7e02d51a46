"""Best-fit packing of token pieces into sequences by a configuration linear program.

Only the histogram of lengths decides how sequences are filled, so the program sees at most
``capacity`` numbers, whatever the size of the corpus. A configuration is a multiset of lengths
that fits one sequence. Multiplicative weights price the lengths: the less of a length is
covered, the more it counts; the best configuration under these prices is found by knapsack
dynamic programming and taken many times at once. What rounding leaves is placed best-fit.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.arrays import python_ready
from tidemark.llm.tokens import encoder
from tidemark.session import checkpointed

ROUNDS = 1500
MOST_STEP, MOST_RATE = 0.2, 200.0
RUN_ROWS = 250_000
TURNS = 64
Plan = list[tuple[tuple[int, ...], int]]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, carried: list[str] | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, *carried): each document's ids and ``end_id``, cut to fit.

    Pieces are full but for the first, which takes the remainder. ``tokenizer`` is a path that
    every task can read.
    """
    python_ready(docs.sparkSession)
    carried = carried or []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, bounds = encoder(tokenizer).encode(batch.column("text"))
            rows, piece, start, length, crc = [], [], [], [], []
            for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                raw = flat[a:b].astype("<u4").tobytes() + int(end_id).to_bytes(4, "little")
                n = b - a + 1
                low, high, k = 0, (n - 1) % capacity + 1, 0
                while low < n:
                    rows.append(row)
                    piece.append(k)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(raw[4 * low : 4 * high]))
                    low, high, k = high, high + capacity, k + 1
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(taken),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    *(batch.column(c).take(taken) for c in carried),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", *carried],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = [f"doc_id {kind}", "piece int", "start long", "length long", "ids_crc32 long", *(f"{c} long" for c in carried)]
    return docs.select("doc_id", "text", *carried).mapInArrow(cut, ", ".join(fields))


def best_configuration(prices: np.ndarray, most: np.ndarray, capacity: int) -> list[int]:
    """The lengths of the most valuable filling of one sequence (knapsack by dynamic programming).

    ``prices`` by length, 0 for those not to be had; a length is taken at most ``most`` times.
    """
    value = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth = prices[1 : room + 1] + value[room - 1 :: -1] if room > 1 else prices[1:2] + value[:1]
        length = int(worth.argmax()) + 1
        value[room] = worth[length - 1]
        taken[room] = length
    out, room, used = [], capacity, Counter()
    while room > 0:
        length = int(taken[room])  # one without a price is room left free
        if used[length] < most[length]:
            out.append(length)
            used[length] += 1
        room -= length
    return out


def best_fit(counts: np.ndarray, capacity: int) -> Plan:
    """Best-fit decreasing on the histogram: all sequences of one filling move together."""
    open_bins: dict[int, Plan] = {}  # by free room
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for room in range(length, capacity) if left else ():
            groups = open_bins.get(room)
            while left and groups:
                held, n = groups.pop()
                moved = min(left, n)
                if n > moved:
                    groups.append((held, n - moved))
                open_bins.setdefault(room - length, []).append(((*held, length), moved))
                left -= moved
        each = capacity // length
        for times, n in ((each, left // each), (left % each, 1)):
            if times and n:
                open_bins.setdefault(capacity - times * length, []).append(((length,) * times, n))
    return [group for groups in open_bins.values() for group in groups]


def linear_program(counts: np.ndarray, capacity: int) -> dict[tuple[int, ...], float]:
    """How often each filling is used in a near-optimal fractional cover of ``counts``.

    Starting from the lengths themselves, the price of a length falls exponentially with its
    coverage. Every round takes the best filling under the prices, as often as covers the
    share ``step`` of one of its lengths.
    """
    lengths = np.flatnonzero(counts)
    used: dict[tuple[int, ...], float] = {}
    if not len(lengths):
        return used
    rounds = min(ROUNDS, 50 + int(counts.sum()) // 8)  # with few pieces the rounding decides
    step = min(MOST_STEP, len(lengths) / rounds)
    rate = min(MOST_RATE, 1 / step)
    covered = np.zeros(len(counts))
    prices = np.zeros(len(counts))
    need = counts.astype(float)
    size = lengths.astype(float)
    for _ in range(2 * rounds):
        share = covered[lengths] / need[lengths]
        if (size * need[lengths] * np.minimum(share, 1)).sum() >= (size * need[lengths]).sum() * (1 - step):
            break
        prices[lengths] = size * np.exp(-rate * (share - share.min()))
        chosen = tuple(best_configuration(prices, counts, capacity))
        times = min(step * need[x] / k for x, k in Counter(chosen).items())
        used[chosen] = used.get(chosen, 0.0) + times
        for x in chosen:
            covered[x] += times
    scale = max(1.0, float((covered[lengths] / need[lengths]).mean()))
    return {held: times / scale for held, times in used.items()}


def configurations(counts: dict[int, int], capacity: int) -> Plan:
    """(lengths, times) that cover every length exactly ``counts`` times.

    The program is rounded down and what it leaves is placed best-fit. Where many lengths make
    that a little worse than placing everything best-fit, the latter is the plan.
    """
    total = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        total[length] = n
    left, rounded = total.copy(), []
    for held, times in sorted(linear_program(total, capacity).items(), key=lambda x: -x[1]):
        need = Counter(held)
        n = min([int(times), *(int(left[x]) // k for x, k in need.items())])
        if n:
            rounded.append((held, n))
            for x, k in need.items():
                left[x] -= n * k
    plans = [rounded + best_fit(left, capacity), best_fit(total, capacity)]
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def interleaved(plan: Plan) -> Plan:
    """The same fillings, each in up to ``TURNS`` portions that take turns over the whole plan."""
    portions = []
    for held, n in plan:
        turns = min(n, TURNS)
        cuts = [n * k // turns for k in range(turns + 1)]
        portions += [((low + high) / 2 / n, held, high - low) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
    return [(held, n) for _, held, n in sorted(portions)]


def _slots(plan: Plan) -> dict[str, np.ndarray]:
    """Ranges of ranks within a length: which sequences they fill, and where."""
    length, times, first, offset, sequence = [], [], [], [], 0
    for held, n in plan:
        at = 0
        for x in held:
            length.append(x)
            times.append(n)
            first.append(sequence)
            offset.append(at)
            at += x
        sequence += n
    table = {k: np.array(v, np.int64) for k, v in (("length", length), ("times", times), ("first", first), ("offset", offset))}
    order = np.argsort(table["length"], kind="stable")
    table = {k: v[order] for k, v in table.items()}
    before = np.cumsum(table["times"]) - table["times"]
    heads = np.searchsorted(table["length"], table["length"])
    table["rank"] = before - before[heads] if len(order) else before
    return table


def pack(pieces: DataFrame, capacity: int, order: list[str] | None = None) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` lies in 1 to ``capacity``.

    Pieces of one length are interchangeable. They are ranked in runs of bounded size, and the
    plan says which ranks go where. ``order`` names a run of rows and a place in it, both long:
    pieces of one length are then ranked so, the plan's fillings take turns, and sequences are
    numbered by the mean place of their tokens, so that they follow the order of the rows. The
    two columns are left out of the result.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = configurations(counts, capacity)
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(interleaved(plan) if order else plan))
    runs = 16 + sum(counts.values()) // RUN_ROWS
    if order:
        dealt, last = pieces.withColumn("_run", F.col(order[0])), [order[1]]
    else:
        dealt, last = pieces.withColumn("_run", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(runs))), []
    sizes = dealt.groupBy("length", "_run").count()
    before = sizes.withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_run")) - F.col("count"))
    within = Window.partitionBy("length", "_run").orderBy(*last, "doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(before.drop("count"), ["length", "_run"])
    ranked = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        keys = table["length"] * (1 << 44) + table["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * (1 << 44) + rank, "right") - 1
            sequence = table["first"][at] + rank - table["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(table["offset"][at])],
                [*names, "sequence_id", "offset"],
            )

    placed = ranked.mapInArrow(place, schema)
    return _renumbered(checkpointed(placed), order).drop(*order) if order else placed


def _renumbered(placed: DataFrame, order: list[str]) -> DataFrame:
    """``placed`` with sequences numbered by the mean place of their tokens.

    A place is a run's rows before it and the place in the run; sequences are counted in
    ``RUN_ROWS`` // 8 rows of places, then within those.
    """
    run, at = order
    lengths = placed.groupBy(run).agg((F.max(at) + 1).alias("_rows"))  # one row a run, that is a file
    start = (F.sum("_rows").over(Window.orderBy(run)) - F.col("_rows")).alias("_start")
    begun = placed.join(F.broadcast(lengths.select(run, start)), run)
    mean = F.sum((F.col("_start") + F.col(at)) * F.col("length")) / F.sum("length")
    sequences = checkpointed(begun.groupBy("sequence_id").agg(mean.alias("_mean")))
    sequences = sequences.withColumn("_part", F.floor(F.col("_mean") / (RUN_ROWS // 8)))
    sizes = sequences.groupBy("_part").count()
    before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_mean", "sequence_id")) - 1
    numbered = sequences.withColumn("_within", within).join(before, "_part")
    numbered = checkpointed(numbered.select("sequence_id", (F.col("_before") + F.col("_within")).alias("_new")))
    return placed.join(numbered, "sequence_id").select(
        *(F.col("_new").alias(c) if c == "sequence_id" else c for c in placed.columns)
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, order: list[str] | None = None
) -> DataFrame:
    """Every piece of every document of ``docs`` (doc_id, text, ...) with its place in a sequence.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts
    are the end id alone. Repeated rows and equal texts are packed each for itself; a null
    doc_id is carried as it is. ``order`` names columns of ``docs``, as in :func:`pack`. Other
    columns are left out. An empty table gives an empty table.
    """
    return pack(checkpointed(token_pieces(docs, tokenizer, capacity, end_id, order)), capacity, order)
