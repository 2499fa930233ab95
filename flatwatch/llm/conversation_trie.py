"""The trie of conversations with shared beginnings, by balanced parentheses per shard.

A node is a distinct sequence of leading turns, named by a 127-bit polynomial hash of its turns' 128-bit hashes. The hash
composes, so a conversation that spreads over several tasks is chained from parts: tasks hold sorted ranges of turns, and
only one row per range (the run that may go on in the next) is folded on the driver.

Every node belongs to its smallest member, and what a conversation owns is the lower end of its path. A node's weight is
thus known in one record only, while every record also carries the spine above it. Records (a conversation's turns, in
blocks of at most ``BLOCK``) are range-sorted by path and each task encodes them in shards of bounded size as balanced
parentheses. ``findclose``, answered with the minima of blocks of excess values, delimits the subtree of a node; the rank
of marked leaf pairs ``()`` and cumulative weights at both ends give its leaves and savings. A node that stands in several
shards is on their shared spine: its parts add up in one aggregation, as every weight was counted in one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flatwatch.llm.common import table
from flatwatch.session import materialize

#: Path hash: h(turns + [t]) = h(turns) * BASE + t modulo a Mersenne prime; 0 is the root.
PRIME, BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F
ROOT = bytes(16)

#: Turns of one record, nodes of one shard, ids of one piece of a digest.
BLOCK, SHARD, IDS = 256, 100_000, 4096


# --- paths ---------------------------------------------------------------------------------------------------------

def chained(turns: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """(conv_id, nth from 1, path, up, key, cp, last) of turns in ``order`` within their conversation.

    ``turns`` has conv_id, key (16 bytes) and cp. Range partitions split a conversation of any length; what goes on in
    the next partition is composed on the driver from one row per partition.
    """
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, nth, path, held = None, 0, 0, None

        def rows(out: list) -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 8
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=["conv_id", "part", "nth", "path", "up", "key", "cp", "last"])

        for batch in batches:
            out = []
            for c, key, cp in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "key", "cp"))):
                if held:
                    out.append((*held, c != conv))
                if c != conv:
                    conv, nth, path = c, 0, 0
                up, nth, path = path, nth + 1, (path * BASE + int.from_bytes(key)) % PRIME
                held = (c, part, nth, path.to_bytes(16), up.to_bytes(16), key, cp)
            yield rows(out)
        if held:
            yield rows([(*held, True)])             # the last of its partition; the next one may go on with it

    source = turns.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order).select("conv_id", "key", "cp")
    local = materialize(source.mapInArrow(chain, "conv_id long, part int, nth long, path binary, up binary, key binary, "
                                                 "cp long, last boolean"), name)
    ends = (local.filter("last").groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("conv_id"),
                                                     F.max_by(F.struct("nth", "path"), "conv_id").alias("run"))
            .orderBy("part").collect())              # a row per partition
    before: dict[int, tuple[int, int, int]] = {}     # part -> the conversation that goes on, its turns so far, their hash
    goes_on: dict[int, int] = {}
    run = (None, 0, 0)
    for n, e in enumerate(ends):
        if e["first"] == run[0]:
            before[e["part"]] = run
            goes_on[ends[n - 1]["part"]] = run[0]
        nth, path = e["run"]["nth"], int.from_bytes(e["run"]["path"])
        if e["conv_id"] == run[0]:
            nth, path = run[1] + nth, (run[2] * pow(BASE, nth, PRIME) + path) % PRIME
        run = (e["conv_id"], nth, path)
    if not before:
        return local.drop("part")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for i, (c, p, nth) in enumerate(zip(rows["conv_id"], rows["part"], rows["nth"])):
                if rows["last"][i] and goes_on.get(p) == c:
                    rows["last"][i] = False
                if before.get(p, (None,))[0] == c:
                    _, done, so_far = before[p]
                    rows["nth"][i] = done + nth
                    for col, k in (("path", nth), ("up", nth - 1)):
                        rows[col][i] = ((so_far * pow(BASE, k, PRIME) + int.from_bytes(rows[col][i])) % PRIME).to_bytes(16)
            yield pa.RecordBatch.from_pydict(rows, schema=batch.schema)

    return local.mapInArrow(compose, local.schema).drop("part")


def rebuilt(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id; their turns after the rebuilding: conv_id, nth, path, up, cp, last).

    The first h turns come from conversation c - c % 100, h being crc32(c as decimal) % 6, then c's own turns after its
    first h. Turns of one number stand in order of role and turn hash; a null number comes first, null ids are left out.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"),
        F.unhex(F.md5(F.concat_ws(":", F.length(role_).cast("string"), role_, text_))).alias("key"),
        F.length(text_).cast("long").alias("cp"))
    own = chained(turns, ["turn", "role", "key"], "trie-turns").select("conv_id", F.col("nth") - 1, "key", "cp").toDF(
        "conv_id", "at", "key", "cp")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    ids = materialize(own.select("conv_id").distinct(), "trie-ids")
    bases = own.filter((F.col("conv_id") % 100 == 0) & (F.col("at") < 5)).withColumnRenamed("conv_id", "base")
    copied = (ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(bases, "base")     # 5 rows a base
              .filter(F.col("at") < shared).select("conv_id", "at", "key", "cp"))
    kept = own.filter(F.col("at") >= shared)
    return ids, chained(kept.unionByName(copied), ["at"], "trie-paths").drop("key")


# --- balanced parentheses ------------------------------------------------------------------------------------------

class Parentheses:
    """Excess values of a parenthesis sequence with the minima of blocks, and of blocks of blocks, in a tree."""

    WIDTH = 64

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        n = 1 << max(0, -(-len(opens) // self.WIDTH) - 1).bit_length()
        padded = np.full(n * self.WIDTH, len(opens) + 1)
        padded[:len(opens)] = self.excess
        self.blocks = padded.reshape(n, self.WIDTH)
        self.tree = np.full(2 * n, len(opens) + 1)
        self.tree[n:] = self.blocks.min(axis=1)
        for level in range(n.bit_length() - 2, -1, -1):
            lo = 1 << level
            self.tree[lo:2 * lo] = np.minimum(self.tree[2 * lo:4 * lo:2], self.tree[2 * lo + 1:4 * lo:2])
        self.leaves = n

    def _first(self, block: np.ndarray, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place from ``start`` on within ``block`` whose excess is at most ``target``, or -1."""
        out, slice_ = np.full(len(block), -1), 1 << 16
        for s in range(0, len(block), slice_):
            b = slice(s, s + slice_)
            fits = (self.blocks[block[b]] <= target[b, None]) & (np.arange(self.WIDTH) >= start[b, None])
            out[b] = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one at ``at``: the first later place with one less excess."""
        target = self.excess[at] - 1
        block = (at + 1) // self.WIDTH
        place = self._first(block, (at + 1) % self.WIDTH, target)
        out = block * self.WIDTH + place
        todo = np.flatnonzero(place < 0)
        node = block[todo] + self.leaves
        open_ = np.ones(len(todo), bool)
        while open_.any():                          # up, until a right neighbour reaches low enough
            right = (node % 2 == 0) & (self.tree[np.minimum(node + 1, len(self.tree) - 1)] <= target[todo])
            node = np.where(open_, np.where(right, node + 1, node // 2), node)
            open_ &= ~right
        while (node < self.leaves).any():           # down, to the leftmost block that does
            left = self.tree[np.minimum(2 * node, len(self.tree) - 1)] <= target[todo]
            node = np.where(node < self.leaves, np.where(left, 2 * node, 2 * node + 1), node)
        block = node - self.leaves
        out[todo] = block * self.WIDTH + self._first(block, np.zeros(len(todo), np.int64), target[todo])
        return out


Record = tuple[list[bytes], list[int], list[bool], list[bool], int, int]


def encode(records: list[Record], later: bool = False) -> dict[str, list | np.ndarray]:
    """A row per node of the shard: path, up (of a node whose parent another record owns), saved, leaves, children.

    ``records`` are sorted by their paths: (paths, weights, owned, leaf, saved and leaves of the blocks that follow).
    ``later``: blocks after the first. They begin with the last turn of the block before, which already has their sums.
    """
    opens: list[bool] = []
    paths: list[bytes] = []
    at: list[int] = []                               # place of a node's opening parenthesis
    saved: list[int] = []
    leaves: list[int] = []
    marked: list[bool] = []                          # a leaf of the whole trie, owned here
    owner: list[int] = []                            # the record that owns a node, or -1
    stack: list[int] = []
    for n, (path, weight, owned, leaf, more_saved, more_leaves) in enumerate(records):
        same = 0
        while same < min(len(stack), len(path)) and paths[stack[same]] == path[same]:
            same += 1
        opens += [False] * (len(stack) - same)
        del stack[same:]
        for p in path[same:]:
            stack.append(len(paths))
            at.append(len(opens))
            opens.append(True)
            paths.append(p)
            saved.append(0)
            leaves.append(0)
            marked.append(False)
            owner.append(-1)
        for node, w, o, f in zip(stack, weight, owned, leaf):
            if o:
                saved[node] += w
                owner[node], marked[node] = n, f
        saved[stack[-1]] += more_saved
        leaves[stack[-1]] += more_leaves
    opens += [False] * len(stack)
    bits, open_at = np.array(opens), np.array(at, np.int64)
    parens = Parentheses(bits)
    close = parens.findclose(open_at)
    pair = bits & ~np.append(bits[1:], True)
    values = np.zeros((2, len(bits)), np.int64)
    values[0, open_at] = saved
    values[1, open_at] = leaves + (pair[open_at] & np.array(marked))          # rank of leaf pairs
    upto = np.cumsum(values, axis=1)
    inside = upto[:, close] - upto[:, open_at] + values[:, open_at]
    parent = np.full(len(paths), -1)
    depth = parens.excess[open_at]
    trail: list[int] = []
    for i, d in enumerate(depth.tolist()):
        del trail[d - 1:]
        parent[i] = trail[-1] if trail else -1
        trail.append(i)
    top, of = parent < 0, np.array(owner)
    if later:
        inside[:, top] = 0
    children = np.bincount(parent[~top & (of >= 0)], minlength=len(paths))
    elsewhere = ~top & (of >= 0) & (of[parent] != of)
    up = [paths[p] if e else None for p, e in zip(parent.tolist(), elsewhere.tolist())]
    return {"path": paths, "up": up, "saved": inside[0], "leaves": inside[1], "children": children}


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted records -> the nodes of each shard. A shard ends where it has ``SHARD`` turns or a new block depth begins."""
    def out(held: list[Record]) -> pa.RecordBatch:
        rows = encode(held, depth > 0)
        kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

    held: list[Record] = []
    size, depth = 0, None
    for batch in batches:
        for block, path, weight, owned, leaf, more_saved, more_leaves in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (size >= SHARD or block != depth):
                yield out(held)
                held, size = [], 0
            held.append((path, weight, owned, leaf, more_saved, more_leaves))
            size, depth = size + len(path), block
    if held:
        yield out(held)


# --- the nodes -----------------------------------------------------------------------------------------------------

def digests(ends: DataFrame) -> DataFrame:
    """(path, ends_sha256) over the ascending ids (path, conv_id). Ids are first joined to texts of ``IDS`` ids in range
    partitions, so the one task that a digest needs reads few rows, and streams them."""
    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, first, ids = None, 0, []

        def out(rows: list) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.string()))],
                                              names=["path", "first", "ids"])
        for batch in batches:
            rows = []
            for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != path or len(ids) == IDS:
                    if ids:
                        rows.append((path, first, ",".join(ids)))
                    path, first, ids = p, c, []
                ids.append(str(c))
            yield out(rows)
        if ids:
            yield out([(path, first, ",".join(ids))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state = None, None
        for batch in batches:
            rows = []
            for p, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != path:
                    if state:
                        rows.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([state.hexdigest()])], names=["path", "ends_sha256"])

    pieces = (ends.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
              .mapInArrow(join_ids, "path binary, first long, ids string"))
    return (pieces.repartition("path").sortWithinPartitions("path", "first").select("path", "ids")
            .mapInArrow(digest, "path binary, ends_sha256 string"))


def records(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(block, paths, weights, owned, leaf, saved and leaves of later blocks) of conversations that own a node.

    Members and the nodes they own meet by conversation and block of depths: at most 2 * ``BLOCK`` rows a group.
    """
    block = lambda c: F.floor(c / BLOCK).cast("int")
    none = lambda t: F.lit(None).cast(t)
    rows = members.select("conv_id", "depth", "path", F.when((F.col("depth") > 0) & (F.col("depth") % BLOCK == 0), F.col("up")).alias("lead"),
                          none("long").alias("weight"), none("boolean").alias("leaf"))
    owned = nodes.select(F.col("owner").alias("conv_id"), "depth", none("binary").alias("path"), none("binary").alias("lead"), "weight", "leaf")
    groups = (rows.unionByName(owned).withColumn("block", block(F.col("depth"))).groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(F.when(F.col("path").isNotNull(), F.struct("depth", "path")))).alias("on"),
        F.sort_array(F.collect_list(F.when(F.col("path").isNull(), F.struct("depth", "weight", "leaf")))).alias("of"),
        F.max("lead").alias("lead")))
    # What a conversation owns is the lower end of its path: a block owns a suffix of its turns.
    lead = F.array_compact(F.array("lead"))
    spine = F.size(lead) + F.size("on") - F.size("of")
    pad = lambda value, col: F.concat(F.array_repeat(value, spine), F.col("of")[col])
    groups = groups.select(
        "conv_id", "block", F.concat(lead, F.col("on.path")).alias("paths"), pad(F.lit(0).cast("long"), "weight").alias("weights"),
        F.concat(F.array_repeat(F.lit(False), spine), F.array_repeat(F.lit(True), F.size("of"))).alias("owned"),
        pad(F.lit(False), "leaf").alias("leaf"),
        F.aggregate("of.weight", F.lit(0).cast("long"), lambda a, w: a + w).alias("own_saved"),
        F.size(F.filter("of.leaf", lambda x: x)).cast("long").alias("own_leaves"), F.size("of").alias("n"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    more = lambda c: F.coalesce(F.sum(c).over(later), F.lit(0)).cast("long")
    groups = groups.withColumns({"more_saved": more("own_saved"), "more_leaves": more("own_leaves"), "more_n": more("n")})
    return groups.filter((F.col("n") > 0) | (F.col("more_n") > 0)).select(
        "block", "paths", "weights", "owned", "leaf", "more_saved", "more_leaves")


def conversation_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """A row per node: path (16 bytes), conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Null roles and texts are empty, rows without a conversation id are left out, repeated rows are turns of their own, and
    other columns are ignored. An empty table has no members and so no nodes, not even the root.
    """
    ids, paths = rebuilt(conversations, conv_id, turn, role, text)
    with_turns = paths.filter("nth = 1").select("conv_id", F.lit(False).alias("with_turns"))
    roots = ids.join(with_turns, "conv_id", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("path"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("cp"),
        F.coalesce("with_turns", F.lit(True)).alias("last"))
    members = paths.select("conv_id", F.col("nth").alias("depth"), "path", "up", "cp", "last").unionByName(materialize(roots, "trie-roots"))
    nodes = materialize(
        members.groupBy("path").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
                                    F.max("depth").alias("depth"), F.max("cp").alias("cp"),
                                    F.count_if("last").alias("ends"))
        .select("path", "owner", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("cp")).alias("weight"),
                (F.col("ends") == F.col("n_convs")).alias("leaf")), "trie-nodes")
    parts = (records(members, nodes).repartitionByRange("block", "paths").sortWithinPartitions("block", "paths")
             .mapInArrow(shards, "path binary, up binary, saved long, leaves long, children long"))
    columns = {"up": "binary", "saved": "long", "leaves": "long", "children": "long", "owner": "long", "depth": "long",
               "n_convs": "long", "ends_sha256": "string"}
    pad = lambda df: df.select("path", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c)
                                         for c, t in columns.items()])
    merged = materialize(
        pad(parts).unionByName(pad(nodes)).unionByName(pad(digests(members.filter("last")))).groupBy("path").agg(
            *[(F.sum if c in ("saved", "leaves", "children") else F.max)(c).alias(c) for c in columns]), "trie-merged")
    apart = merged.filter(F.col("up").isNotNull()).join(
        nodes.select(F.col("path").alias("up"), F.col("owner").alias("parent_conv_id")), "up")
    within = merged.filter(F.col("up").isNull()).withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("owner")))
    return within.unionByName(apart).select(
        "path", F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("path")
