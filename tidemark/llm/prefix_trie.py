"""Shared prefixes of conversations as a trie, one balanced-parentheses sequence per shard.

Every conversation is rebuilt (see :func:`rebuilt`) and the rebuilt ones are ranged over the
tasks by their turn sequences, so each task (a shard) holds a contiguous run of the sorted
order and its part of the trie is one depth-first walk. The walk is written as balanced
parentheses, '(' when a node opens and ')' when it closes. ``findclose`` on that sequence,
answered from blocks of minimum excess, gives the end of each node's subtree; the number of
"()" pairs in a subtree (a rank) is its number of childless nodes; cumulative arrays over the
opening places give members and savings of a subtree as two differences.

A node whose members all lie in one shard is whole there and leaves the task finished. Only
nodes on the paths of a shard's first and last conversation can reach into other shards: these
spines are merged afterwards. Spines of neighbouring shards are the same node up to the
longest common prefix of the conversations at their border, so each spine node is named by
the leftmost shard it reaches; then children, members, leaves and savings are added up along
the merged spines in one task. That task holds two paths a shard (at most 2 x shards x the
longest conversation's turns), not rows. The conversation ids ending at a spine node are
written by the shards to the shared folder and hashed in border order as a stream.

Defined cases: rows with a null conv_id take no part; null role or text is empty; turns with
the same turn number are ordered by role, then text; a conversation without turns (also after
rebuilding) is a member of the root only and ends there; repeated rows are repeated turns; an
empty table gives no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import python_ready
from tidemark.session import checkpointed, shared_folder

# Fixed values of the contract: the first h turns come from conversation c - c % GROUP, h = crc32 % SPREAD.
GROUP, SPREAD = 5, 9
BLOCK = 64

TURN = "struct<h:bigint,role:string,text:string>"
SHARD_SCHEMA = (
    "kind int, s int, side int, depth int, conv_id long, parent_conv_id long, parent_side int, n_convs long, "
    "n_children long, n_leaves long, saved long, ends_sha256 string, bytes long, ends_file string, ends_at long, "
    f"ends_len long, inner int, turns array<{TURN}>"
)
NODE, SPINE, BORDER = 0, 1, 2


def rebuilt(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, turns (array of h, role, text in order), after the rebuild."""
    t = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = checkpointed(t.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "role", "text"))
    sizes = t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = sizes.select(
        "conv_id",
        (F.crc32(F.col("conv_id").cast("string")) % SPREAD).cast("int").alias("h"),
        (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
    )
    kept = convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("kept")
    )
    inherited = kept.join(t.select(F.col("conv_id").alias("base"), "pos", "role", "text"), "base").where(
        F.col("pos") < F.col("h")
    ).select("conv_id", "pos", "role", "text")
    own = kept.join(t, "conv_id").where(F.col("pos") >= F.col("h")).select(
        "conv_id", (F.col("kept") + F.col("pos") - F.col("h")).alias("pos"), "role", "text"
    )
    turns = inherited.unionByName(own).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.xxhash64("role", "text").alias("h"), "role", "text"))).alias("t")
    )
    return kept.select("conv_id").join(turns, "conv_id", "left").select(
        "conv_id",
        F.transform(F.coalesce("t", F.array().cast(f"array<struct<pos:bigint,h:bigint,role:string,text:string>>")),
                    lambda x: F.struct(x["h"].alias("h"), x["role"].alias("role"), x["text"].alias("text"))).alias("turns"),
    )


class Parentheses:
    """A balanced-parentheses sequence with minimum excess kept per block of ``BLOCK`` places."""

    def __init__(self, opens: np.ndarray):
        self.bits = opens.astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        padded = np.concatenate((self.excess, np.full(-len(self.excess) % BLOCK, np.iinfo(np.int64).max)))
        self.block_min = padded.reshape(-1, BLOCK).min(axis=1)

    def findclose(self, i: int) -> int:
        """The place of the ')' that closes the '(' at ``i``."""
        want = self.excess[i] - 1
        end = min((i // BLOCK + 1) * BLOCK, len(self.excess))
        inside = np.flatnonzero(self.excess[i + 1 : end] == want)
        if len(inside):
            return i + 1 + int(inside[0])
        later = np.flatnonzero(self.block_min[i // BLOCK + 1 :] <= want)
        block = i // BLOCK + 1 + int(later[0])
        return block * BLOCK + int(np.flatnonzero(self.excess[block * BLOCK : (block + 1) * BLOCK] == want)[0])


def _lcp(a: list, b: list) -> int:
    k, most = 0, min(len(a), len(b))
    while k < most and a[k] == b[k]:
        k += 1
    return k


def _ends_text(ids: list[int]) -> bytes:
    return ",".join(map(str, ids)).encode()


def shard_trie(conv_ids: list[int], turns: list[list[tuple]]) -> dict:
    """The trie of one shard's sorted conversations: per node its open and close place and counts."""
    m = len(conv_ids)
    depth, parent, last_bytes, first, last = [0], [-1], [0], [0], [m - 1]
    ends: list[list[int]] = [[]]
    bits, opened = [1], [0]
    stack = [0]
    for i in range(m):
        common = _lcp(turns[i - 1], turns[i]) if i else 0
        while depth[stack[-1]] > common:
            last[stack.pop()] = i - 1
            bits.append(0)
        for d in range(common + 1, len(turns[i]) + 1):
            depth.append(d)
            parent.append(stack[-1])
            last_bytes.append(len(turns[i][d - 1][2].encode()))
            first.append(i)
            last.append(m - 1)
            ends.append([])
            opened.append(len(bits))
            bits.append(1)
            stack.append(len(depth) - 1)
        ends[stack[-1]].append(conv_ids[i])
    bits.extend([0] * len(stack))
    return {
        "depth": np.asarray(depth),
        "parent": np.asarray(parent),
        "bytes": np.asarray(last_bytes, np.int64),
        "first": np.asarray(first),
        "last": np.asarray(last),
        "ends": ends,
        "bits": np.asarray(bits, np.int8),
        "open": np.asarray(opened),
    }


def shard_nodes(conv_ids: list[int], turns: list[list[tuple]]) -> dict:
    """Per node: members, smallest member, children, and subtree sums over nodes whole in the shard."""
    trie = shard_trie(conv_ids, turns)
    m, n_nodes = len(conv_ids), len(trie["depth"])
    bp = Parentheses(trie["bits"])
    opens = trie["open"]
    closes = np.asarray([bp.findclose(int(i)) for i in opens])
    spine = (trie["first"] == 0) | (trie["last"] == m - 1)
    at_open = np.zeros(len(trie["bits"]) + 1, np.int64)
    ending = np.asarray([len(e) for e in trie["ends"]], np.int64)
    at_open[opens + 1] = ending
    members = np.cumsum(at_open)
    n_convs = members[closes + 1] - members[opens]
    bits = trie["bits"]
    leaf = np.zeros(len(bits) + 1, np.int64)
    pair = np.flatnonzero((bits[:-1] == 1) & (bits[1:] == 0))
    leaf[pair + 1] = 1
    leaf[opens[spine] + 1] = 0  # a spine node may have children in other shards
    leaves = np.cumsum(leaf)
    n_leaves = leaves[closes + 1] - leaves[opens]
    worth = np.zeros(len(bits) + 1, np.int64)
    worth[opens + 1] = np.where(spine, 0, (n_convs - 1) * trie["bytes"])
    savings = np.cumsum(worth)
    saved = savings[closes + 1] - savings[opens]
    smallest = np.asarray([min(e) if e else np.iinfo(np.int64).max for e in trie["ends"]], np.int64)
    order = np.argsort(-trie["depth"], kind="stable")
    for node in order:
        if trie["parent"][node] >= 0:
            p = trie["parent"][node]
            smallest[p] = min(smallest[p], smallest[node])
    children = np.bincount(trie["parent"][1:], minlength=n_nodes) if n_nodes > 1 else np.zeros(1, np.int64)
    whole_child = ~spine[1:]
    own_children = np.bincount(trie["parent"][1:][whole_child], minlength=n_nodes)
    own_leaves = np.bincount(trie["parent"][1:][whole_child], weights=n_leaves[1:][whole_child], minlength=n_nodes)
    own_saved = np.bincount(trie["parent"][1:][whole_child], weights=saved[1:][whole_child], minlength=n_nodes)
    return {
        **trie,
        "spine": spine,
        "n_convs": n_convs,
        "n_leaves": n_leaves,
        "saved": saved,
        "smallest": smallest,
        "children": children,
        "own_children": own_children,
        "own_leaves": own_leaves.astype(np.int64),
        "own_saved": own_saved.astype(np.int64),
        "inner": _lcp(turns[0], turns[-1]) if m else 0,
    }


def _shard_pass(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_ids, turns = [], []
        for batch in batches:
            conv_ids.extend(batch.column("conv_id").to_pylist())
            turns.extend([(t["h"], t["role"], t["text"]) for t in row] for row in batch.column("turns").to_pylist())
        if not conv_ids:
            return
        context = TaskContext.get()
        s = context.partitionId()
        nodes = shard_nodes(conv_ids, turns)
        fs, root = _fs(folder)
        name = f"{root}/ends-{s:05d}-{context.attemptNumber()}-{uuid.uuid4().hex}.txt"
        out: dict[str, list] = {k: [] for k in pa.schema(_fields()).names}

        def emit(**values):
            for k in out:
                out[k].append(values.get(k))

        spine, depth, parent = nodes["spine"], nodes["depth"], nodes["parent"]
        side = np.where(nodes["first"] == 0, 0, 1)
        written = 0
        with fs.open_output_stream(name) as ends_file:
            for x in range(len(depth)):
                if not spine[x]:
                    p = parent[x]
                    emit(
                        kind=NODE, s=s, depth=int(depth[x]), conv_id=int(nodes["smallest"][x]),
                        parent_conv_id=None if spine[p] else int(nodes["smallest"][p]),
                        parent_side=int(side[p]) if spine[p] else None,
                        n_convs=int(nodes["n_convs"][x]), n_children=int(nodes["children"][x]),
                        n_leaves=int(nodes["n_leaves"][x]), saved=int(nodes["saved"][x]),
                        ends_sha256=hashlib.sha256(_ends_text(nodes["ends"][x])).hexdigest(),
                    )
                else:
                    text = _ends_text(nodes["ends"][x])
                    ends_file.write(text)
                    emit(
                        kind=SPINE, s=s, side=int(side[x]), depth=int(depth[x]),
                        conv_id=int(nodes["smallest"][x]),
                        n_convs=int(nodes["n_convs"][x]), n_children=int(nodes["own_children"][x]),
                        n_leaves=int(nodes["own_leaves"][x]), saved=int(nodes["own_saved"][x]),
                        bytes=int(nodes["bytes"][x]), ends_file=name, ends_at=written, ends_len=len(text),
                    )
                    written += len(text)
        for at, row in ((0, 0), (1, len(conv_ids) - 1)):
            emit(kind=BORDER, s=s, side=at, inner=nodes["inner"],
                 turns=[{"h": h, "role": r, "text": t} for h, r, t in turns[row]])
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(_fields()))

    return run


def _fields() -> list[pa.Field]:
    turn = pa.struct([("h", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = []
    for part in SHARD_SCHEMA.split(", "):
        name, kind = part.split(" ", 1)
        fields.append(pa.field(name, pa.list_(turn) if kind.startswith("array") else kinds[kind]))
    return fields


def _fs(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        folder = "/" + folder[len("file:") :].lstrip("/")
    if folder.startswith("/"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


def _borders(parts: DataFrame) -> DataFrame:
    """Per non-empty shard in order: its first side's link to the previous shard's last conversation."""
    border = parts.where(F.col("kind") == BORDER)
    first = border.where("side = 0").select("s", "inner", F.col("turns").alias("a"))
    last = border.where("side = 1").select("s", F.col("turns").alias("b"))
    linked = first.join(last, "s").select(
        "s", "inner", "a", F.lag("b").over(Window.orderBy("s")).alias("before")
    )  # two rows a shard
    same = F.zip_with("before", "a", lambda x, y: x == y)
    at = F.array_position(same, False)
    lcp = F.when(F.col("before").isNull(), F.lit(-1)).when(
        at == 0, F.least(F.size("before"), F.size("a"))
    ).otherwise(at - 1)
    return linked.select("s", "inner", lcp.cast("int").alias("link"))


def _merge_spines(folder: str):
    """In one task: spine rows and borders to final nodes, and (s, side, depth) -> conv_id of each spine place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).to_pandas()
        borders = table[table["kind"] == BORDER].sort_values("s")
        spines = table[table["kind"] == SPINE]
        shards = borders["s"].to_numpy()
        position = {int(s): 2 * k for k, s in enumerate(shards)}
        bound = np.empty(2 * len(shards), np.int64)
        bound[0::2] = borders["link"].to_numpy()
        bound[1::2] = borders["inner"].to_numpy()

        def canonical(q: int, d: int) -> int:
            while q > 0 and bound[q] >= d:
                q -= 1
            return q

        raw = {}
        for row in spines.itertuples(index=False):
            q = position[int(row.s)] + int(row.side)
            raw[(q, int(row.depth))] = row
        nodes: dict[tuple[int, int], dict] = {}
        for (q, d), row in sorted(raw.items()):
            key = (canonical(q, d), d)
            node = nodes.setdefault(
                key, {"n": 0, "min": np.iinfo(np.int64).max, "children": 0, "leaves": 0, "saved": 0, "bytes": 0, "pieces": []}
            )
            node["n"] += int(row.n_convs)
            node["min"] = min(node["min"], int(row.conv_id))
            node["children"] += int(row.n_children)
            node["leaves"] += int(row.n_leaves)
            node["saved"] += int(row.saved)
            node["bytes"] = int(row.bytes)
            if row.ends_len:
                node["pieces"].append((row.ends_file, int(row.ends_at), int(row.ends_len)))
        parent = {key: (canonical(key[0], key[1] - 1), key[1] - 1) if key[1] else None for key in nodes}
        for key, up in parent.items():
            if up is not None:
                nodes[up]["children"] += 1
        for key, node in nodes.items():
            node["leaf"] = node["children"] == 0
            node["sub_leaves"] = node["leaves"] + int(node["leaf"])
            node["sub_saved"] = node["saved"] + (node["n"] - 1) * node["bytes"]
        for key in sorted(nodes, key=lambda k: -k[1]):
            up = parent[key]
            if up is not None:
                nodes[up]["sub_leaves"] += nodes[key]["sub_leaves"]
                nodes[up]["sub_saved"] += nodes[key]["sub_saved"]
        fs, _ = _fs(folder)
        out: dict[str, list] = {k: [] for k in ("kind", "s", "side", "depth", "conv_id", "parent_conv_id", "n_convs",
                                                "n_children", "n_leaves", "saved", "ends_sha256")}
        for key, node in nodes.items():
            digest = hashlib.sha256()
            begun = False
            for name, at, size in node["pieces"]:
                if begun:
                    digest.update(b",")
                with fs.open_input_file(name) as f:
                    while size:
                        step = min(size, 1 << 20)
                        digest.update(f.read_at(step, at))
                        at, size = at + step, size - step
                begun = True
            up = parent[key]
            for k, v in (("kind", NODE), ("s", None), ("side", None), ("depth", key[1]), ("conv_id", node["min"]),
                         ("parent_conv_id", nodes[up]["min"] if up else None), ("n_convs", node["n"]),
                         ("n_children", node["children"]), ("n_leaves", node["sub_leaves"]),
                         ("saved", node["sub_saved"]), ("ends_sha256", digest.hexdigest())):
                out[k].append(v)
        for (q, d) in raw:
            row = raw[(q, d)]
            for k, v in (("kind", SPINE), ("s", int(row.s)), ("side", int(row.side)), ("depth", d),
                         ("conv_id", nodes[(canonical(q, d), d)]["min"]), ("parent_conv_id", None), ("n_convs", None),
                         ("n_children", None), ("n_leaves", None), ("saved", None), ("ends_sha256", None)):
                out[k].append(v)
        schema = pa.schema([(k, pa.int32() if k in ("kind", "s", "side", "depth") else
                             pa.string() if k == "ends_sha256" else pa.int64()) for k in out])
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


MERGED = ("kind int, s int, side int, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved long, ends_sha256 string")
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    python_ready(spark)
    folder = f"{shared_folder(spark)}/trie-{uuid.uuid4().hex}"
    fs, root = _fs(folder)
    fs.create_dir(root, recursive=True)
    ordered = rebuilt(conversations).orderBy("turns", "conv_id")
    parts = checkpointed(ordered.mapInArrow(_shard_pass(folder), SHARD_SCHEMA))
    borders = _borders(parts)
    spines = parts.where(F.col("kind") == SPINE).select(
        "kind", "s", "side", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "bytes", "ends_file",
        "ends_at", "ends_len", F.lit(None).cast("int").alias("link"), F.lit(None).cast("int").alias("inner"),
    )
    marks = borders.select(
        F.lit(BORDER).alias("kind"), "s", F.lit(0).alias("side"), *(F.lit(None).cast("int").alias(c) for c in ["depth"]),
        *(F.lit(None).cast("long").alias(c) for c in ["conv_id", "n_convs", "n_children", "n_leaves", "saved", "bytes"]),
        F.lit(None).cast("string").alias("ends_file"), *(F.lit(None).cast("long").alias(c) for c in ["ends_at", "ends_len"]),
        "link", "inner",
    )
    merged = checkpointed(spines.unionByName(marks).repartition(1).mapInArrow(_merge_spines(folder), MERGED))
    places = merged.where(F.col("kind") == SPINE).select(
        "s", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up")
    )
    whole = parts.where(F.col("kind") == NODE).join(places, ["s", "parent_side", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256",
    )
    spined = merged.where(F.col("kind") == NODE).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )
    return whole.unionByName(spined).select(
        *(F.col(c).cast("long") if c != "ends_sha256" else F.col(c) for c in RESULT)
    )
