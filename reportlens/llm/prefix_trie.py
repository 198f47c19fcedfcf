"""Prefix tries of conversations, built as z-fast tries and merged on Spark.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns,
known by a 128-bit hash chained over the turns. Every task builds a z-fast trie of its
conversations: only branching points and ends are nodes (a compacted trie), and a table holds each
node by the hash of its handle, its path cut at the two-fattest depth of its edge. A fat binary
search probes that table a logarithmic number of times to find where a conversation leaves the
trie; the edge there is split, a leaf added. Conversations are inserted in batches, equal ones once
with their number. In the end edges are expanded to one row per depth, and the rows of all tasks
are added up per node.

Subtree sums need no walk over the merged trie. A node belongs to its smallest member; the nodes
that a conversation owns are the last of its path, from some depth on. What a subtree adds up,
(members - 1) times bytes over its nodes, is then the bytes of the turns at nodes that the members
don't own: every conversation adds the path above its own nodes. This path, with its bytes, is
inserted into a second round of tries, and so is the whole path of each owner of a leaf; sums over
the members below a node give ``saved_tokens`` and ``n_leaves``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import land

KEY = 16
ROOT_KEY = bytes(KEY)
#: Turns of the paths that a task keeps in one trie; then it is expanded and a new one begun.
TURNS = 200_000
#: Conversations inserted at once.
BATCH = 512
ROWS = 20_000
#: Ids put into one text of a node's ends at once.
IDS = 10_000


# --- the trie of one task ---------------------------------------------------------------


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that most powers of two divide."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """The edge from depth ``low`` (exclusive) to ``high`` on the path ``keys``, and what lies below it.

    ``upto`` has the bytes of the path's first turns, by their number.
    """

    __slots__ = ("keys", "upto", "low", "high", "children", "values", "least")

    def __init__(self, keys: Sequence[bytes], upto: Sequence[int], low: int, high: int, width: int) -> None:
        self.keys, self.upto, self.low, self.high = keys, upto, low, high
        self.children: dict[bytes, Node] = {}
        self.values = [0] * width
        self.least: int | None = None

    @property
    def handle(self) -> bytes:
        return self.keys[two_fattest(self.low, self.high)]


class ZFastTrie:
    """A compacted trie over key paths; ``values`` are added up where paths end.

    A path is the list of the keys of its prefixes, that of the empty one first. Equal keys mean
    equal prefixes, so two paths are alike up to the last depth at which their keys are.
    """

    def __init__(self, width: int) -> None:
        self.width, self.turns = width, 0
        self.root = Node([ROOT_KEY], [0], -1, 0, width)
        self.table: dict[bytes, Node] = {ROOT_KEY: self.root}

    def lowest(self, keys: Sequence[bytes], length: int) -> Node:
        """The deepest node whose whole path is a prefix of ``keys[: length + 1]``: fat binary search."""
        node, low, high = self.root, 0, length
        while low < high:
            middle = two_fattest(low, high)
            found = self.table.get(keys[middle])
            if found is not None and found.high <= length and found.keys[found.high] == keys[found.high]:
                node, low = found, found.high
            else:
                high = middle - 1
        return node

    def insert(self, keys: Sequence[bytes], upto: Sequence[int], length: int, values: Sequence[int], least: int) -> None:
        """Add ``values`` at the end of the path's first ``length`` turns."""
        node = self.lowest(keys, length)
        if node.high < length:
            below = node.children.get(keys[node.high + 1])
            if below is not None:
                node, below = self.split(node, below, keys, length)
            if node.high < length:
                leaf = Node(keys, upto, node.high, length, self.width)
                node.children[keys[node.high + 1]] = leaf
                self.table[leaf.handle] = leaf
                self.turns += len(keys)
                node = leaf
        node.values = [a + b for a, b in zip(node.values, values)]
        node.least = least if node.least is None else min(node.least, least)

    def split(self, parent: Node, below: Node, keys: Sequence[bytes], length: int) -> tuple[Node, Node]:
        """Cut the edge to ``below``, where the path leaves it; returns the new node and the rest."""
        low, high = below.low + 1, min(below.high, length)
        while low < high:  # the last depth at which both are alike
            middle = (low + high + 1) // 2
            low, high = (middle, high) if below.keys[middle] == keys[middle] else (low, middle - 1)
        del self.table[below.handle]
        node = Node(below.keys, below.upto, below.low, low, self.width)
        below.low = low
        node.children[below.keys[low + 1]] = below
        parent.children[node.keys[node.low + 1]] = node
        self.table[node.handle], self.table[below.handle] = node, below
        return node, below

    def expanded(self) -> Iterator[tuple[Node, int, list[int], int | None]]:
        """(node of the edge, depth, sums below, smallest id below) of every depth of every edge."""
        order = [self.root]
        for node in order:
            order.extend(node.children.values())
        for node in reversed(order):  # children before their parents
            for child in node.children.values():
                node.values = [a + b for a, b in zip(node.values, child.values)]
                if node.least is None or (child.least is not None and child.least < node.least):
                    node.least = child.least
        for node in order:
            for depth in range(node.low + 1, node.high + 1):
                yield node, depth, node.values, node.least


# --- paths ------------------------------------------------------------------------------


def path_keys(turns: Sequence[bytes]) -> list[bytes]:
    """The key of every prefix, that of the empty one first."""
    keys = [ROOT_KEY]
    for turn in turns:
        keys.append(hashlib.blake2b(keys[-1] + turn, digest_size=KEY).digest())
    return keys


def with_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [path_keys(turns.as_py()) for turns in batch["turns"]]
        out = [batch["conv_id"], pa.array([k[-1] for k in keys], pa.binary()), pa.array(keys, pa.list_(pa.binary())), batch["sizes"]]
        yield pa.RecordBatch.from_arrays(out, names=["conv_id", "end", "keys", "sizes"])


def own_share(conv_id: Column) -> Column:
    """Number of turns taken from the first conversation of the family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(turns: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id`` and its rebuilt turns as arrays ``turns`` (hashes) and ``sizes`` (bytes).

    Texts stay where they are read: only their hashes and sizes travel. The first 8 turns at most
    are handed on to the family, so its first conversation is never repeated as a whole.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    sign = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    slim = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.substring(sign, 1, 2 * KEY)).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "key")
    placed = land(slim.withColumn("place", F.row_number().over(order)).drop("turn", "role"), "turns")
    own = placed.withColumn("taken", own_share(F.col("conv_id")))
    own = own.select("conv_id", F.when(F.col("place") > F.col("taken"), F.struct(F.lit(1).alias("part"), "place", "key", "size")).alias("turn"))
    family = placed.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("first"), own_share(F.col("conv_id")).alias("taken")
    )
    heads = placed.where("place <= 8").select(F.col("conv_id").alias("first"), "place", "key", "size")
    given = family.where("taken > 0").join(heads, "first").where("place <= taken")
    given = given.select("conv_id", F.struct(F.lit(0).alias("part"), "place", "key", "size").alias("turn"))
    # A conversation all of whose turns are replaced by none keeps its rows here, with a null turn.
    whole = own.unionByName(given).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("list"))
    return whole.select("conv_id", F.col("list.key").alias("turns"), F.col("list.size").alias("sizes"))


# --- the two rounds -----------------------------------------------------------------------


NODES = "key binary, parent binary, depth long, conv_id long, n long"
SUMS = "key binary, n long, total long, leaves long"


def chunks(rows: Iterator[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))

    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield batch()
            held.clear()
    if held:
        yield batch()


def tries(batches: Iterator[pa.RecordBatch], width: int, inserts) -> Iterator[ZFastTrie]:
    """Tries of all rows; ``inserts`` gives (length, values) for each row, equal paths are inserted once."""
    trie = ZFastTrie(width)
    for part in (batch.slice(k, BATCH) for batch in batches for k in range(0, batch.num_rows, BATCH)):
        collapsed: dict[bytes, list] = {}
        for row in part.to_pylist():
            for length, values in inserts(row):
                same = collapsed.get(row["keys"][length])
                if same is None:
                    collapsed[row["keys"][length]] = [row["keys"], list(accumulate(row["sizes"], initial=0)), length, list(values), row["conv_id"]]
                else:
                    same[3] = [a + b for a, b in zip(same[3], values)]
                    same[4] = min(same[4], row["conv_id"])
        for keys, upto, length, values, least in collapsed.values():
            trie.insert(keys, upto, length, values, least)
            if trie.turns >= TURNS:
                yield trie
                trie = ZFastTrie(width)
    yield trie


def count_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``NODES``: what the task's conversations say about each node they pass."""

    def rows() -> Iterator[tuple]:
        for trie in tries(batches, 1, lambda row: [(len(row["sizes"]), (1,))]):
            for node, depth, values, least in trie.expanded():
                if least is not None:
                    yield node.keys[depth], node.keys[depth - 1] if depth else None, depth, least, values[0]

    long, key = pa.int64(), pa.binary()
    yield from chunks(rows(), ("key", "parent", "depth", "conv_id", "n"), (key, key, long, long, long))


def sum_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SUMS`` from rows with ``above``, the number of first turns whose nodes the conversation
    doesn't own (null: none, not even the root), and ``leaf``."""

    def inserts(row: dict) -> Iterator[tuple[int, tuple[int, int, int]]]:
        if row["above"] is not None:
            yield row["above"], (1, sum(row["sizes"][: row["above"]]), 0)
        if row["leaf"]:
            yield len(row["sizes"]), (0, 0, 1)

    def rows() -> Iterator[tuple]:
        for trie in tries(batches, 3, inserts):
            for node, depth, (n, total, leaves), least in trie.expanded():
                if least is not None:
                    yield node.keys[depth], n, total - n * (node.upto[depth - 1] if depth else 0), leaves

    yield from chunks(rows(), ("key", "n", "total", "leaves"), (pa.binary(), pa.int64(), pa.int64(), pa.int64()))


# --- ends ---------------------------------------------------------------------------------


def id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, first, text`` from rows sorted by key and id: ids of a node, up to ``IDS`` in a text."""

    def rows() -> Iterator[tuple]:
        key, ids = None, []
        for batch in batches:
            for end, conv_id in zip(batch["end"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (end != key or len(ids) == IDS):
                    yield key, ids[0], ",".join(map(str, ids))
                    ids = []
                key = end
                ids.append(conv_id)
        if ids:
            yield key, ids[0], ",".join(map(str, ids))

    yield from chunks(rows(), ("key", "first", "text"), (pa.binary(), pa.int64(), pa.string()))


def end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, ends_sha256`` from texts sorted by key and first id; a hash takes one text at a time."""

    def rows() -> Iterator[tuple]:
        key, digest = None, None
        for batch in batches:
            for node, text in zip(batch["key"].to_pylist(), batch["text"]):
                if node != key:
                    if digest is not None:
                        yield key, digest.hexdigest()
                    key, digest = node, hashlib.sha256(text.as_py().encode())
                else:
                    digest.update(b"," + text.as_py().encode())
        if digest is not None:
            yield key, digest.hexdigest()

    yield from chunks(rows(), ("key", "ends_sha256"), (pa.binary(), pa.string()))


def ends(paths: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the nodes at which conversations end.

    A hash is sequential, but its text isn't: ranges of (node, id) are joined to texts in parallel,
    so a node at which a third of all conversations end is spread over tasks; only the hashing of
    its texts, in their order, is one task's.
    """
    dealt = paths.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    texts = dealt.mapInArrow(id_texts, "key binary, first long, text string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(end_hashes, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the rebuilt conversations' trie.

    Reads ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Rows without a
    conv_id take no part. Turns are ordered by ``turn``, null first, equal ones by role, then by
    hash; repeated rows are repeated turns. Null roles and texts are empty; empty texts have 0
    bytes. A text is hashed where it is read, whatever its length. An empty table gives no row.
    A conversation is one row of 24 bytes a turn.
    """
    paths = land(
        rebuilt(turns).mapInArrow(with_paths, "conv_id long, end binary, keys array<binary>, sizes array<long>"), "paths"
    )
    seen = paths.select("conv_id", "keys", "sizes").mapInArrow(count_members, NODES)
    nodes = land(
        seen.groupBy("key").agg(
            F.first("parent").alias("parent"),
            F.first("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n").alias("n_convs"),
        ),
        "nodes",
    )
    children = nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    children = land(children.withColumnRenamed("parent", "of"), "children")
    counted = nodes.join(children, nodes["key"] == children["of"], "left").drop("of")
    counted = land(counted.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted")
    owners = counted.groupBy(F.col("conv_id").alias("owner")).agg(
        F.min("depth").alias("from_depth"), F.max(F.col("n_children") == 0).alias("leaf")
    )
    owned = paths.join(owners, paths["conv_id"] == owners["owner"], "left")
    above = F.coalesce("from_depth", F.size("sizes") + 1) - 1
    owned = owned.select(
        "conv_id", "keys", "sizes", F.when(above >= 0, above).alias("above"), F.coalesce("leaf", F.lit(False)).alias("leaf")
    )
    sums = owned.mapInArrow(sum_subtrees, SUMS).groupBy("key").agg(F.sum("total").alias("total"), F.sum("leaves").alias("n_leaves"))
    parents = counted.select(F.col("key").alias("of"), F.col("conv_id").alias("parent_conv_id"))
    found = (
        counted.join(parents, counted["parent"] == parents["of"], "left")
        .drop("of")
        .join(land(sums, "sums"), "key", "left")
        .join(land(ends(paths), "ends"), "key", "left")
    )
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"),
        F.coalesce("total", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
