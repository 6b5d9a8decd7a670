"""Prefix trie of conversations, built from adaptive radix trees over turn ids.

Every distinct (role, text) gets a dense number, written big-endian in as many bytes as the count needs,
so a conversation is a string of bytes. Each task puts its conversations into adaptive radix trees:
nodes grow from 4 to 16, 48 and 256 children, and paths without a branch are kept as one run of bytes.
A tree node is a trie node only where its depth in bytes falls between two turns, be it a branch or a
place inside a compressed path.

A tree holds some thousands of conversations and is then written out as partial trie nodes, and Spark adds
the parts up by node, so no prefix, however many conversations share it, meets in one task. A node's name
is a hash chained over the turns down to it. Conversations are cut every SEGMENT turns; a later segment
starts from the name of the node where the one before it ends, so no conversation is one long key.

Sums over subtrees need no walk over the trie either. Of the conversations through a node the smallest
stands for it. ``before(c)`` is the length of c's path above the first node that c stands for (its whole
length if it stands for none); then the tokens saved below a node v are the sum of before(c) over v's
conversations, without v's own smallest one, less (n - 1) times the path above v: again a sum over
conversations, which a second pass through the trees adds up. Leaves count in the same way.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import keep, prepare, release_memory

SEGMENT = 256
# A tree is written out when it holds so many segments or bytes of keys.
TREE_KEYS = 4_096
TREE_BYTES = 4 * 1024 * 1024
NAME = 16
ROOT = bytes(NAME)
# Turn numbers of a conversation that are ordered together.
TURNS_PER_BUCKET = 1_024
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# Adaptive radix tree

class Sorted:
    """Up to 4 or 16 children under sorted bytes. A node also holds the keys that end at it."""
    __slots__ = ("prefix", "ends", "most", "keys", "children", "total")

    def __init__(self, prefix: bytes, most: int = 4):
        self.prefix, self.ends, self.most = prefix, [], most
        self.keys, self.children = bytearray(), []

    def child(self, byte: int):
        i = bisect_left(self.keys, byte)
        return self.children[i] if i < len(self.keys) and self.keys[i] == byte else None

    def put(self, byte: int, node):
        """This node, or a larger one in its place, with the child added or replaced."""
        i = bisect_left(self.keys, byte)
        if i < len(self.keys) and self.keys[i] == byte:
            self.children[i] = node
            return self
        if len(self.keys) < self.most:
            self.keys.insert(i, byte)
            self.children.insert(i, node)
            return self
        larger = Sorted(self.prefix, 16) if self.most == 4 else Indexed(self.prefix)
        larger.ends = self.ends
        for key, old in self.items():
            larger.put(key, old)
        return larger.put(byte, node)

    def items(self) -> list:
        return list(zip(self.keys, self.children))


class Indexed:
    """Up to 48 children behind a table of 256 places."""
    __slots__ = ("prefix", "ends", "places", "children", "total")

    def __init__(self, prefix: bytes):
        self.prefix, self.ends, self.places, self.children = prefix, [], bytearray(256), []

    def child(self, byte: int):
        at = self.places[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, node):
        at = self.places[byte]
        if at:
            self.children[at - 1] = node
            return self
        if len(self.children) < 48:
            self.children.append(node)
            self.places[byte] = len(self.children)
            return self
        larger = Direct(self.prefix)
        larger.ends = self.ends
        for key, old in self.items():
            larger.put(key, old)
        return larger.put(byte, node)

    def items(self) -> list:
        return [(byte, self.children[at - 1]) for byte, at in enumerate(self.places) if at]


class Direct:
    """A child for each byte."""
    __slots__ = ("prefix", "ends", "children", "total")

    def __init__(self, prefix: bytes):
        self.prefix, self.ends, self.children = prefix, [], [None] * 256

    def child(self, byte: int):
        return self.children[byte]

    def put(self, byte: int, node):
        self.children[byte] = node
        return self

    def items(self) -> list:
        return [(byte, node) for byte, node in enumerate(self.children) if node is not None]


class RadixTree:
    """Keys of bytes, each with a payload; a key may be the beginning of another."""

    def __init__(self):
        self.root = None

    def insert(self, key: bytes, payload) -> None:
        if self.root is None:
            self.root = self._leaf(key, payload)
            return
        parent, edge, node, at = None, 0, self.root, 0
        while True:
            prefix, rest = node.prefix, key[at:at + len(node.prefix)]
            if prefix != rest:
                same = next((i for i, (x, y) in enumerate(zip(prefix, rest)) if x != y), min(len(prefix), len(rest)))
                upper = Sorted(prefix[:same])
                node.prefix = prefix[same + 1:]
                upper.put(prefix[same], node)
                self._replace(parent, edge, upper)
                node = upper
            at += len(node.prefix)
            if at == len(key):
                node.ends.append(payload)
                return
            below = node.child(key[at])
            if below is None:
                larger = node.put(key[at], self._leaf(key[at + 1:], payload))
                if larger is not node:
                    self._replace(parent, edge, larger)
                return
            parent, edge, node, at = node, key[at], below, at + 1

    @staticmethod
    def _leaf(rest: bytes, payload) -> Sorted:
        leaf = Sorted(rest)
        leaf.ends.append(payload)
        return leaf

    def _replace(self, parent, edge: int, node) -> None:
        if parent is None:
            self.root = node
        else:
            parent.put(edge, node)

    def add_up(self, of, plus) -> None:
        """Set ``total`` of each node: payloads at and below it, by ``of`` one and ``plus`` two totals."""
        order, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            order.append(node)
            stack += [child for _, child in node.items()]
        for node in reversed(order):
            total = None
            for payload in node.ends:
                total = of(payload) if total is None else plus(total, of(payload))
            for _, child in node.items():
                total = child.total if total is None else plus(total, child.total)
            node.total = total


# From segments to partial trie nodes

def chained(name: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(name + turn, digest_size=NAME).digest()


PARTS = "node binary, parent binary, depth long, first long, n long, chars long, path long, ends array<long>, weights array<long>"


class Grower:
    """Collects segments in a tree and writes its trie nodes out.

    A key is the name of the node where the segment starts, then the turns. Payloads are (conversation,
    whether it ends here, weights).
    """

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.tree, self.keys, self.bytes = RadixTree(), 0, 0
        self.chars: dict[bytes, int] = {}
        self.starts: dict[bytes, tuple[int, int]] = {ROOT: (0, 0)}

    def add(self, start: bytes, depth: int, path: int, turns: list[bytes], chars: list[int], payload) -> None:
        self.starts[start] = (depth, path)
        self.chars.update(zip(turns, chars))
        key = start + b"".join(turns)
        self.tree.insert(key, payload)
        self.keys += 1
        self.bytes += len(key)

    @property
    def full(self) -> bool:
        return self.keys >= TREE_KEYS or self.bytes >= TREE_BYTES

    def nodes(self) -> Iterator[tuple]:
        """Rows of PARTS for the trie nodes of the tree."""
        if self.tree.root is None:
            return
        self.tree.add_up(
            lambda p: (p[0], 1, p[2]),
            lambda x, y: (min(x[0], y[0]), x[1] + y[1], tuple(a + b for a, b in zip(x[2], y[2]))))
        # (tree node, bytes since the last turn, name, parent, depth, path); the name is None inside the start's name
        stack = [(self.tree.root, b"", None, 0, 0)]
        while stack:
            node, pending, name, depth, path = stack.pop()
            pending += node.prefix
            found = []
            if name is None and len(pending) >= NAME:
                name, pending = pending[:NAME], pending[NAME:]
                depth, path = self.starts[name]
                if depth == 0:
                    found.append((name, None, 0, 0, 0))
            if name is not None:
                while len(pending) >= self.width:
                    turn, pending = pending[:self.width], pending[self.width:]
                    parent, name = name, chained(name, turn)
                    depth, path = depth + 1, path + self.chars[turn]
                    found.append((name, parent, depth, self.chars[turn], path))
            first, n, weights = node.total
            for i, (own, parent, at, chars, so_far) in enumerate(found):
                ends = sorted(p[0] for p in node.ends if p[1]) if i == len(found) - 1 and not pending else []
                yield own, parent, at, first, n, chars, so_far, ends, list(weights)
            for byte, child in node.items():
                stack.append((child, pending + bytes((byte,)), name, depth, path))


def partial_nodes(segments: DataFrame, width: int) -> DataFrame:
    """Rows of PARTS from stored segments (conv, seg, turns array<struct<position, id, chars>>, last, weights).

    Conversations are dealt by range of their number, so the ends of one part are neither below nor
    above those of another, but all before or all after them.
    """
    dealt = segments.repartitionByRange("conv").sortWithinPartitions("conv", "seg")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grower, conv, state = Grower(width), None, None
        names = ["node", "parent", "depth", "first", "n", "chars", "path", "ends", "weights"]
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.list_(pa.int64()), pa.list_(pa.int64())]

        def written() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in grower.nodes():
                rows.append(row)
                if len(rows) == 5_000:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)
            grower.clear()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["seg"] == 0:
                    conv, state = row["conv"], (ROOT, 0, 0)
                start, depth, path = state
                turns = [t["id"].to_bytes(width, "big") for t in row["turns"]]
                chars = [t["chars"] for t in row["turns"]]
                grower.add(start, depth, path, turns, chars, (conv, row["last"], tuple(row["weights"])))
                if not row["last"]:
                    name = start
                    for turn in turns:
                        name = chained(name, turn)
                    state = (name, depth + len(turns), path + sum(chars))
                if grower.full:
                    yield from written()
        yield from written()
        release_memory()

    return dealt.mapInArrow(run, PARTS)


# Turns

def encode_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(conv, turn, key, chars): stored rows, the SHA-256 of role and text in place of them. Runs a Spark job.

    A null role or text is an empty one. Rows without a conversation belong to none and are left out.
    """
    prepare(turns.sparkSession)
    role_text, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return keep(turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role_text).cast("string"), F.lit(":"), role_text, said), 256)).alias("key"),
        F.length(said).cast("long").alias("chars")))


def number_turns(encoded: DataFrame) -> tuple[DataFrame, int]:
    """((conv, position, id, chars) stored, bytes of an id). Runs Spark jobs.

    Positions count from 0 by turn, null turns first; rows of one turn number stand by the hash of role
    and text. Ids are dense over the distinct (role, text).
    """
    # Positions: rows of a conversation are counted in steps of turn numbers and ordered inside a step.
    step = F.coalesce(F.floor(F.col("turn") / TURNS_PER_BUCKET), F.lit(-(1 << 62)))
    stepped = encoded.withColumn("step", step)
    sizes = stepped.groupBy("conv", "step").agg(F.count("*").alias("rows"))
    ahead = Window.partitionBy("conv").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv", "step", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "step").orderBy(F.col("turn").asc_nulls_first(), "key")
    placed = stepped.withColumn("rank", F.row_number().over(inside)).join(sizes, ["conv", "step"]).select(
        "conv", (F.col("before") + F.col("rank") - 1).alias("position"), "key")
    # Numbers: hashes are even over 4,096 first bits; a running sum over these gives where each begins.
    distinct = keep(encoded.groupBy("key").agg(F.max("chars").alias("chars"))
                    .withColumn("part", F.conv(F.hex(F.substring("key", 1, 2)), 16, 10).cast("int").bitwiseAND(4095)))
    below = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = distinct.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(below), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("key")) - 1
    numbers = distinct.withColumn("rank", rank).join(F.broadcast(firsts), "part").select(  # 4,096 rows at most
        "key", (F.col("first") + F.col("rank")).cast("long").alias("id"), "chars")
    width = max(1, (distinct.count().bit_length() + 7) // 8)
    return keep(placed.join(numbers, "key").select("conv", "position", "id", "chars")), width


def segments_of(numbered: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv, seg, turns, last, total), stored: the turns of each SEGMENT positions. Runs a Spark job.

    ``conversations`` (conv) may name some without turns: each has one empty segment.
    """
    turns = numbered.select("conv", F.floor(F.col("position") / SEGMENT).alias("seg"),
                            F.struct("position", "id", "chars").alias("turn"))
    if conversations is not None:
        turns = turns.unionByName(conversations.select(
            "conv", F.lit(0).cast("long").alias("seg"), F.lit(None).cast(turns.schema["turn"].dataType).alias("turn")))
    cut = turns.groupBy("conv", "seg").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    whole = Window.partitionBy("conv")
    length = F.aggregate("turns", F.lit(0).cast("long"), lambda x, t: x + t["chars"])
    return keep(cut.select("conv", "seg", "turns", (F.col("seg") == F.max("seg").over(whole)).alias("last"),
                           F.sum(length).over(whole).alias("total")))


# The trie

def _hashed_ends(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) for nodes at which conversations end.

    Numbers are sorted and joined in parts; the hash of a node runs over its parts in order, one at a time.
    """
    ends = parts.where(F.size("ends") > 0).select(
        "node", F.element_at("ends", 1).alias("start"), F.array_join(F.col("ends").cast("array<string>"), ",").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            names, hashes = [], []
            for own, part in zip(batch.column("node").to_pylist(), batch.column("part").to_pylist()):
                if own == node:
                    digest.update(b"," + part.encode())
                    continue
                if node is not None:
                    names.append(node)
                    hashes.append(digest.hexdigest())
                node, digest = own, hashlib.sha256(part.encode())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes)], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])],
                                             names=["node", "ends_sha256"])

    return ends.repartition("node").sortWithinPartitions("node", "start").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(numbered: DataFrame, width: int, conversations: DataFrame | None = None) -> DataFrame:
    """One row for each distinct beginning of the conversations, the empty one included. Runs Spark jobs.

    Input as from ``number_turns``; result: node, parent (names), conv_id (smallest member), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Members
    equal turn by turn share all nodes. No conversations give no rows, not even a root.
    """
    segments = segments_of(numbered, conversations)
    parts = keep(partial_nodes(segments.withColumn("weights", F.array().cast("array<long>")), width))
    nodes = keep(parts.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("first").alias("first"),
        F.sum("n").alias("n"), (F.max("path") - F.max("chars")).alias("above")))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count("*").alias("n_children"))
    nodes = keep(nodes.join(children, "node", "left").fillna(0, ["n_children"]))
    # What a conversation adds to the sums: the path above its first own node, and the leaf it stands for.
    stands = nodes.groupBy(F.col("first").alias("conv")).agg(
        F.min("above").alias("before"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    weighted = segments.join(stands, "conv", "left").select(
        "conv", "seg", "turns", "last",
        F.array(F.coalesce("before", "total"), F.coalesce("leaf", F.lit(0).cast("long"))).alias("weights"))
    sums = partial_nodes(keep(weighted), width).groupBy("node").agg(
        F.sum(F.col("weights")[0]).alias("before"), F.sum(F.col("weights")[1]).alias("n_leaves"))
    own = stands.select(F.col("conv").alias("first"), F.col("before").alias("own"))
    upper = nodes.select(F.col("node").alias("parent"), F.col("first").alias("parent_conv_id"))
    return (nodes.join(sums, "node").join(_hashed_ends(parts), "node", "left").join(own, "first")
            .join(upper, "parent", "left").select(
        "node", "parent", F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        "n_children", "n_leaves",
        (F.col("before") - F.col("own") - (F.col("n") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))


def trie_of(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """The prefix trie of a table of turns (see ``prefix_trie``); other columns are not read. Runs Spark jobs."""
    numbered, width = number_turns(encode_turns(turns, conv, turn, role, text))
    return prefix_trie(numbered, width)
