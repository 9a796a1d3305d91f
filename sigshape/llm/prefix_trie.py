"""Conversation prefix trie: ternary search trees over turn ids, by range.

Turns are dictionary-encoded: each distinct (role, text) has one number, and a
conversation is the sequence of its turns' numbers. Equal sequences are one
entry with its number of members and the smallest of them, so a conversation
that a third of all others copy costs one entry. The entries are dealt into
shards by ranges of their order. A shard builds a ternary search tree, its
median entry first, then the medians of both halves, so that the trees of
siblings stay balanced. One walk with a stack lists the tree's nodes; read
backwards, the list sums members, leaves and savings from the children up.

Entries are in order, so only the prefixes of a shard's first and last entry
can stand in other shards too. These boundary nodes carry their sums without
one another's; ``FAN_IN`` neighbouring shards' boundary nodes are merged by a
digest of their prefix at a time, which leaves the first and last path of the
group, and so on until one group is left. A task never holds more than a shard
or the paths of ``FAN_IN`` groups.

Defined cases: rows without a conversation id belong to none and are left
out; a null role or text is empty; equal turn numbers go by role, then text; a
conversation without turns is a member of the root only; repeated rows are
turns of their own; an empty table gives no rows, not even a root; columns
other than the four are never read. A conversation's turn numbers (not its
texts) are one row, 16 bytes a turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, ship, text_of
from .turns import hashed_pieces, in_order, joined_pieces, turn_digest

#: Turns of a shard, about.
SHARD_TURNS = 50_000
#: Turns of an entry by which shards are dealt; entries alike in all of them share a shard.
DEALT_BY = 64
#: Shards, or groups of them, whose boundary nodes are merged at once.
FAN_IN = 16

_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


class Trie(NamedTuple):
    """``nodes``: conv_id (smallest member), depth, parent_conv_id, the sums,
    and for nodes at which conversations end, ``end`` (key of the sequence),
    ``n_ends`` and ``end_conv_id`` (the smallest). A node's last turn is turn
    number ``depth`` of conversation ``conv_id``. ``ends``: (end, conv_id) of
    the sequences that two or more conversations share."""
    nodes: DataFrame
    ends: DataFrame


def turn_sequences(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, seq): every conversation's turns as (id, n): number in the
    dictionary, bytes of the text."""
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                text_of(role_col).alias("role"), text_of(text_col).alias("text")).where("conv_id IS NOT NULL")
    turns = in_order(rows, {"digest": turn_digest(), "n": F.octet_length("text").cast("bigint")}, "trie-turns")
    entries = saved(turns.select("digest").distinct().select(F.col("digest").alias("of"), F.monotonically_increasing_id().alias("id")),
                    "trie-dictionary")
    coded = turns.join(entries, F.col("digest") == F.col("of")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "id", "n"))).alias("seq"))
    return saved(coded.select("conv_id", F.transform("seq", lambda t: F.struct(t["id"].alias("id"), t["n"].alias("n"))).alias("seq")),
                 "trie-sequences")


def _min(a, b):
    return b if a is None else a if b is None else min(a, b)


class _Tree:
    """A ternary search tree; node 0 is the root of the trie."""

    def __init__(self) -> None:
        self.key, self.lo, self.eq, self.hi, self.size = [-1], [-1], [-1], [-1], [0]
        self.n, self.least, self.end = [0], [None], [None]

    def _new(self, key: int, size: int) -> int:
        for column, x in zip((self.key, self.lo, self.eq, self.hi, self.size, self.n, self.least, self.end),
                             (key, -1, -1, -1, size, 0, None, None)):
            column.append(x)
        return len(self.key) - 1

    def insert(self, ids: list[int], sizes: list[int], n: int, least, end: bytes) -> None:
        at = 0
        for k, size in zip(ids, sizes):
            self.n[at] += n
            self.least[at] = _min(self.least[at], least)
            links, i = self.eq, at
            while links[i] >= 0:
                i = links[i]
                if k == self.key[i]:
                    break
                links = self.lo if k < self.key[i] else self.hi
            else:
                new = self._new(k, size)
                links[i] = new
                i = new
            at = i
        self.n[at] += n
        self.least[at] = _min(self.least[at], least)
        self.end[at] = (end, n, least)

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes, parents before children; every node's parent and depth."""
        order, parent, depth = [0], [-1] * len(self.key), [0] * len(self.key)
        stack = [(self.eq[0], 0)] if self.eq[0] >= 0 else []
        while stack:
            i, p = stack.pop()
            order.append(i)
            parent[i], depth[i] = p, depth[p] + 1
            for j, q in ((self.lo[i], p), (self.hi[i], p), (self.eq[i], i)):
                if j >= 0:
                    stack.append((j, q))
        return order, parent, depth

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of an entry that was inserted, from the root."""
        out = [0]
        for k in ids:
            i = self.eq[out[-1]]
            while self.key[i] != k:
                i = self.lo[i] if k < self.key[i] else self.hi[i]
            out.append(i)
        return out


def _grown(entries: list[tuple]) -> _Tree:
    """The tree of sorted entries, by their medians."""
    tree, halves = _Tree(), [(0, len(entries))]
    while halves:
        a, b = halves.pop()
        if a < b:
            mid = (a + b) // 2
            tree.insert(*entries[mid])
            halves += [(mid + 1, b), (a, mid)]
    return tree


def _named(ids: list[int]) -> list[bytes]:
    """Digests of the prefixes of an entry, from the root's."""
    out = [bytes(16)]
    for k in ids:
        out.append(blake2b(out[-1] + k.to_bytes(8, "big", signed=True), digest_size=16).digest())
    return out


_COLUMNS = ("shard", "depth", "node", "parent", "parent_conv_id", "conv_id", "size", *_SUMS,
            "end", "n_ends", "end_conv_id", "left", "right", "open")


def _schema(kind: str) -> str:
    types = {"shard": "bigint", "node": "binary", "parent": "binary", "parent_conv_id": kind, "conv_id": kind,
             "end": "binary", "end_conv_id": kind, "left": "boolean", "right": "boolean", "open": "boolean"}
    return ", ".join(f"{c} {types.get(c, 'bigint')}" for c in _COLUMNS)


def _batch(rows: list[dict], conv_type: pa.DataType) -> pa.RecordBatch:
    types = {"node": pa.binary(), "parent": pa.binary(), "parent_conv_id": conv_type, "conv_id": conv_type, "end": pa.binary(),
             "end_conv_id": conv_type, "left": pa.bool_(), "right": pa.bool_(), "open": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], types.get(c, pa.int64())) for c in _COLUMNS], list(_COLUMNS))


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries (ids, sizes, n, least, key) of a shard -> its nodes.
    A boundary node is ``open``: its sums leave out boundary children, and its
    savings its own."""
    entries: list[tuple] = []
    conv_type = None
    for batch in batches:
        conv_type = batch.schema.field(3).type
        entries += zip(*[batch.column(k).to_pylist() for k in range(5)])
    if not entries:
        return
    shard = TaskContext.get().partitionId()
    tree = _grown(entries)
    left, right = ({i: d for i, d in zip(tree.path(ids), _named(ids))} for ids in (entries[0][0], entries[-1][0]))
    name = left | right
    order, parent, depth = tree.walk()
    children, leaves, savings = ([0] * len(order) for _ in range(3))
    for i in reversed(order):
        if i not in name:
            leaves[i] += children[i] == 0
            savings[i] += (tree.n[i] - 1) * tree.size[i]
            p = parent[i]
            children[p] += 1
            leaves[p] += leaves[i]
            savings[p] += savings[i]
    rows: list[dict] = []
    for i in order:
        p, (end, n_ends, end_conv) = parent[i], tree.end[i] or (None, None, None)
        rows.append({"shard": shard, "depth": depth[i], "node": name.get(i), "parent": name.get(p) if p >= 0 else None,
                     "parent_conv_id": tree.least[p] if p >= 0 and p not in name else None, "conv_id": tree.least[i],
                     "size": tree.size[i], "n_convs": tree.n[i], "n_children": children[i], "n_leaves": leaves[i],
                     "saved_tokens": savings[i], "end": end, "n_ends": n_ends, "end_conv_id": end_conv,
                     "left": i in left, "right": i in right, "open": i in name})
        if len(rows) >= 10_000:
            yield _batch(rows, conv_type)
            rows = []
    if rows:
        yield _batch(rows, conv_type)


def _merge(last: bool):
    """Boundary nodes of neighbouring shards -> the same, merged; the nodes
    that lie inside the group are finished. ``last``: all do."""
    def merge(table: pa.Table) -> pa.Table:
        conv_type = table.schema.field("conv_id").type
        rows = table.to_pylist()
        first, final = min(r["shard"] for r in rows), max(r["shard"] for r in rows)
        nodes: dict[bytes, dict] = {}
        for r in rows:
            x = nodes.get(r["node"])
            if x is None:
                x = nodes[r["node"]] = r | dict.fromkeys(_SUMS, 0) | {"left": False, "right": False, "conv_id": None, "end": None,
                                                                      "n_ends": None, "end_conv_id": None}
            for c in _SUMS:
                x[c] += r[c]
            x["conv_id"] = _min(x["conv_id"], r["conv_id"])
            if r["end"] is not None:
                x |= {c: r[c] for c in ("end", "n_ends", "end_conv_id")}
            x["left"] |= r["left"] and r["shard"] == first
            x["right"] |= r["right"] and r["shard"] == final
        for x in sorted(nodes.values(), key=lambda r: -r["depth"]):
            x["open"] = not last and (x["left"] or x["right"])
            x["shard"] = x["group"]
            if x["open"]:
                continue
            x["n_leaves"] += x["n_children"] == 0
            x["saved_tokens"] += (x["n_convs"] - 1) * x["size"]
            p = nodes.get(x["parent"])
            if p is not None:
                p["n_children"] += 1
                p["n_leaves"] += x["n_leaves"]
                p["saved_tokens"] += x["saved_tokens"]
        return pa.Table.from_batches([_batch(list(nodes.values()), conv_type)])
    return merge


def prefix_trie(sequences: DataFrame) -> Trie:
    """The trie of ``sequences`` (conv_id, seq as ``turn_sequences`` gives it)."""
    spark = sequences.sparkSession
    ship(spark)
    kind = sequences.schema["conv_id"].dataType.simpleString()
    ids = F.transform("seq", lambda t: t["id"])
    keyed = saved(sequences.select("conv_id", "seq", F.unhex(F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)).alias("key")),
                  "trie-keyed")
    entries = saved(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("seq").alias("seq"))
                    .select(ids.alias("ids"), F.transform("seq", lambda t: t["n"]).alias("sizes"), "n", "least", "key"), "trie-entries")
    turns = entries.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = -(-turns // SHARD_TURNS) or 1
    dealt = entries.repartitionByRange(shards, F.slice("ids", 1, DEALT_BY)).sortWithinPartitions("ids")
    parts = saved(dealt.mapInArrow(_shard_nodes, _schema(kind)), "trie-shards")

    closed = parts.where("not open")
    open_, merged = parts.where("open"), []
    shards = 1 + (open_.agg(F.max("shard")).first()[0] or 0)
    while True:
        groups = -(-shards // FAN_IN)
        grouped = open_.withColumn("group", F.floor(F.col("shard") / FAN_IN).cast("bigint")).groupBy("group")
        step = saved(grouped.applyInArrow(_merge(groups == 1), _schema(kind)), "trie-merged")
        merged.append(step.where("not open"))
        if groups == 1:
            break
        open_, shards = step.where("open"), groups
    skeleton = merged[0]
    for m in merged[1:]:
        skeleton = skeleton.unionByName(m)
    names = skeleton.select(F.col("node").alias("of"), F.col("conv_id").alias("of_conv"))
    below = closed.where("parent IS NOT NULL").unionByName(skeleton).join(names, F.col("parent") == F.col("of"), "left")
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS, "end", "n_ends", "end_conv_id"]
    below = below.withColumn("parent_conv_id", F.col("of_conv")).select(columns)
    nodes = closed.where("parent IS NULL").select(columns).unionByName(below)
    shared = entries.where("n > 1").select(F.col("key").alias("of"))
    return Trie(nodes, keyed.join(shared, F.col("key") == F.col("of"), "left_semi").select(F.col("key").alias("end"), "conv_id"))


def rebuilt(sequences: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin as others do: the first h turns of conversation
    c - c % every, then c's own after its first h; h = crc32(c) % heads."""
    c = F.col("conv_id")
    own = sequences.select("conv_id", "seq", (c - c % every).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).cast("int").alias("h"))
    head = sequences.select(c.alias("of"), F.slice("seq", 1, heads - 1).alias("head"))
    none = F.array().cast(sequences.schema["seq"].dataType)
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return own.join(head, F.col("base") == F.col("of"), "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), rest).alias("seq"))


def trie_report(trie: Trie) -> DataFrame:
    """The nodes with ends_sha256: hash of the ids that end there, ascending, comma-joined."""
    of = hashed_pieces(joined_pieces(trie.ends, "end", "conv_id"), ",").select(F.col("key").alias("of"), "sha256")
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS]
    one = F.sha2(F.coalesce(F.col("end_conv_id").cast("string"), F.lit("")).cast("binary"), 256)
    few = trie.nodes.where("coalesce(n_ends, 0) < 2").select(*columns, one.alias("ends_sha256"))
    many = trie.nodes.where("n_ends > 1").join(of, F.col("end") == F.col("of")).select(*columns, F.col("sha256").alias("ends_sha256"))
    return few.unionByName(many)
