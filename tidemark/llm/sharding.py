"""Shards of near equal bytes by histogram sort, with DataFrame operations only.

Rows are ordered by a 64-bit key: the upper half hashes the text, so equal texts stand
together, the lower half hashes the row. Candidate boundaries (probes) cut the keys into bins;
counting the exact bytes of each bin tells the bytes below every probe. Around each wanted
boundary the probes are refined, bin by bin, until one meets the tolerance or a bin is a single
key. Only then are the rows exchanged, once, to their shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.columns import folded, unfolded
from tidemark.session import checkpointed

FIRST_BITS, MORE_BITS = 12, 8
RUN_ROWS = 100_000


def splitters(keys: DataFrame, shards: int, tolerance: float) -> list[int]:
    """Keys at which shards 1, 2, ... begin. ``keys`` has ``_key`` (0 to 2**63 - 1) and ``_size``.

    Each has within ``tolerance`` of a shard's bytes of what should lie below it, if any key
    does. A round returns at most 2**12 bins, or 2**8 bins a boundary, to the driver.
    """
    total = keys.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    wanted = {j: total * j / shards for j in range(1, shards)}
    slack = tolerance * total / shards
    # open[j] = (first key of the bin, bits of its width, bytes below it)
    found: dict[int, int] = {}
    open_bins = {j: (0, 63, 0) for j in wanted}
    bits = FIRST_BITS
    while open_bins:
        frames = []
        for (low, width), js in _grouped(open_bins).items():
            step = max(0, width - bits)
            inside = keys.where((F.col("_key") >= low) & (F.col("_key") <= low + (1 << width) - 1))
            bin_of = F.shiftright(F.col("_key") - F.lit(low), step)
            frames.append(inside.select(F.lit(min(js)).alias("_group"), bin_of.alias("_bin"), "_size"))
        rows = frames[0]
        for frame in frames[1:]:
            rows = rows.union(frame)
        counts = rows.groupBy("_group", "_bin").agg(F.sum("_size").alias("bytes")).collect()
        following = {}
        for (low, width), js in _grouped(open_bins).items():
            step = max(0, width - bits)
            below, bins = open_bins[js[0]][2], []
            for r in sorted((r for r in counts if r["_group"] == min(js)), key=lambda r: r["_bin"]):
                bins.append((low + (r["_bin"] << step), below, below + r["bytes"]))
                below += r["bytes"]
            for j in js:
                start, under, over = next((b for b in bins if b[2] >= wanted[j]), (low, below, below))
                near = min((abs(under - wanted[j]), start), (abs(over - wanted[j]), start + (1 << step)))
                if near[0] <= slack or step == 0:
                    found[j] = near[1]
                else:
                    following[j] = (start, step, under)
        open_bins, bits = following, MORE_BITS
    return [found[j] for j in sorted(found)]


def _grouped(open_bins: dict[int, tuple[int, int, int]]) -> dict[tuple[int, int], list[int]]:
    groups: dict[tuple[int, int], list[int]] = {}
    for j, (low, width, _) in open_bins.items():
        groups.setdefault((low, width), []).append(j)
    return groups


def shard_by_bytes(docs: DataFrame, shards: int = 8, tolerance: float = 0.005) -> DataFrame:
    """``docs`` with ``size``, ``shard`` (from 0) and ``slot`` (gapless from 0 in a shard).

    ``docs`` needs doc_id and text; other columns pass through, but for those that bear one of
    the three names. A row's size is the UTF-8 bytes of its text plus 1, a null text having
    none. Shards have equal bytes to within ``tolerance`` of a shard on either side, as far as
    single keys allow. Equal texts share a shard unless a boundary can meet the tolerance only
    inside their group. Rows that repeat each other in doc_id and text share one key and so one
    shard. In a shard, slots count through runs of bounded size, each sorted by key. Null
    doc_ids and empty texts are rows like others. An empty table gives an empty table.
    """
    given, new = docs, ["size", "shard", "slot"]
    docs = folded(given, ["doc_id", "text"], new)
    text_half = F.shiftrightunsigned(F.xxhash64("text"), 33)
    row_half = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(1), "text"), 32)
    keyed = docs.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")).withColumn(
        "_key", F.shiftleft(text_half, 32) + row_half
    )
    keys = checkpointed(keyed.select("_key", F.col("size").alias("_size")))
    cuts = splitters(keys, shards, tolerance)

    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("_key") >= F.lit(cut)).cast("int")
    rows = keys.count()
    runs = 16 + rows // shards // RUN_ROWS
    # the row half spreads a large group of equal texts over the runs of its shard
    run = F.expr(f"int((_key & 4294967295) % {runs})")
    sizes = keys.select(shard.alias("shard"), run.alias("_run")).groupBy("shard", "_run").count()
    before = sizes.select(
        F.col("shard").alias("_of"),
        F.col("_run").alias("_part"),
        (F.sum("count").over(Window.partitionBy("shard").orderBy("_run")) - F.col("count")).alias("_before"),
    )
    dealt = keyed.withColumn("shard", shard).withColumn("_run", run)
    number = F.row_number().over(Window.partitionBy("shard", "_run").orderBy("_key", "doc_id")) - 1
    numbered = dealt.withColumn("_number", number).join(
        before, (F.col("shard") == F.col("_of")) & (F.col("_run") == F.col("_part"))
    )
    back = unfolded(given, ["doc_id", "text"], new)
    return numbered.select(*back, "size", "shard", (F.col("_number") + F.col("_before")).cast("long").alias("slot"))
