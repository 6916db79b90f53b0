"""Prefix trie of conversations, by burst tries.

A conversation is a sequence of turns; a node of the trie is a distinct sequence
of first turns, its members are the conversations that start with it.

* A turn's id is the SHA-256 of its role and text, and a node's id the SHA-256 of
  its parent's id and its last turn's id, so a sequence is the array of the ids of
  its prefixes, the next turn id after a prefix is the next entry, and texts are
  never shuffled.
* Equal sequences are folded into one string first, with the number, the smallest
  and the digest of all conversation ids behind it.  The ids of a large group of
  copies are range-partitioned, joined to blocks and digested in order.
* Bursting: all strings lie in containers under the heads of the trie.  A container
  of more than ``max_strings`` strings is burst by the next turn id: its prefix
  becomes a head, its strings move to a container per next turn, or end in the head.
  The levels of one round (2, 4, 8, ... turns) are counted in one map-side
  aggregation, so a prefix of a third of all conversations costs no more than any.
* Sweep: the containers are dealt to tasks by their prefix and sorted, and each is
  swept once with the open nodes on a stack: a string closes the nodes it does
  not share with the string before.  A closed node knows its subtree.
* What containers know of their subtrees is added to the heads above them.

A task holds one path and the closed children of its nodes, at most
``max_strings`` strings of a container.  A conversation's ids are one array value.

Hard cases: null roles and texts are empty; null turns come first; rows of one
turn number stand in the order of role, then of the turn's id, and repeated rows are
turns of their own; rows without a conversation id belong to no conversation.  A
conversation without turns is a member of the root.  An empty table has no nodes;
further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize

MAX_STRINGS = 1024
ROOT = hashlib.sha256(b"").digest()
# Conversation ids joined to one block of text before they are digested.
BLOCK_IDS = 65_536
OUT_ROWS = 8192


# --- conversations as sequences --------------------------------------------------------

def turn_id(role: Column, text: Column) -> Column:
    """SHA-256 of role and text; the length tells where the role ends."""
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of a conversation in order, each with its id
    and the code points of its text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct("turn", role.alias("role"), turn_id(role, text).alias("id"),
                            F.length(text).cast("long").alias("size")).alias("t"))
    # arrays sort nulls first, structs by their fields in order
    return (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size")))
                    .alias("turns")))


def with_openings(seqs: DataFrame, donor: Column, first: Column, most: int) -> DataFrame:
    """Every conversation with its first ``first`` turns (at most ``most``)
    taken from the conversation ``donor`` instead of its own."""
    asked = seqs.select("conv_id", "turns", donor.alias("donor"), first.cast("int").alias("first"))
    heads = seqs.select(F.col("conv_id").alias("donor"), F.slice("turns", 1, most).alias("opening"))
    heads = heads.join(asked.select("donor").distinct(), "donor", "left_semi")
    own = F.slice("turns", F.col("first") + 1, F.greatest(F.size("turns") - F.col("first"), F.lit(0)))
    return (asked.join(heads, "donor", "left")
            .select("conv_id", F.when(F.col("opening").isNull(), own)
                    .otherwise(F.concat(F.slice("opening", F.lit(1), F.col("first")), own)).alias("turns")))


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = hashlib.sha256
    for batch in batches:
        paths, sizes = [], []
        for turns in batch.column("turns").to_pylist():
            node, path, size = ROOT, [ROOT], [0]
            for t in turns:
                node = sha(node + t["id"]).digest()
                path.append(node)
                size.append(t["size"])
            paths.append(path)
            sizes.append(size)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())),
                                          pa.array(sizes, pa.list_(pa.int64()))], names=["conv_id", "path", "sizes"])


def paths_of(seqs: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): the node of every depth, the root first, and the
    code points of its last text."""
    return map_batches(seqs.select("conv_id", "turns"), _chain, "conv_id long, path array<binary>, sizes array<long>")


# --- equal sequences ----------------------------------------------------------------------

def _id_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (leaf, conv_id) rows to blocks of comma-joined ids."""
    leaf, ids, rows = None, [], []

    def close() -> None:
        if ids:
            rows.append((leaf, ids[0], len(ids), ",".join(map(str, ids))))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
            names=["leaf", "first", "n", "ids"])

    for batch in batches:
        for key, conv in zip(batch.column("leaf").to_pylist(), batch.column("conv_id").to_pylist()):
            if key != leaf or len(ids) >= BLOCK_IDS:
                close()
                leaf, ids = key, []
                if len(rows) >= OUT_ROWS:
                    yield batch_of()
            ids.append(conv)
    close()
    if rows:
        yield batch_of()


def _digest_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (leaf, first) blocks to one row per leaf."""
    leaf, smallest, n, digest, rows = None, None, 0, None, []

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["m", "n", "ends"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["leaf"] != leaf:
                if digest is not None:
                    rows.append((smallest, n, digest.hexdigest()))
                leaf, smallest, n, digest = row["leaf"], row["first"], 0, hashlib.sha256()
                if len(rows) >= OUT_ROWS:
                    yield batch_of()
            else:
                digest.update(b",")
            digest.update(row["ids"].encode())
            n += row["n"]
    if digest is not None:
        rows.append((smallest, n, digest.hexdigest()))
    if rows:
        yield batch_of()


def strings_of(members: DataFrame) -> DataFrame:
    """One row per distinct sequence: its smallest conversation ``m``, their
    number ``n``, the digest of all their ids, path and sizes."""
    ids = members.select(F.element_at("path", -1).alias("leaf"), "conv_id")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = map_batches(ids.repartitionByRange(parts, "leaf", "conv_id").sortWithinPartitions("leaf", "conv_id"),
                         _id_blocks, "leaf binary, first long, n long, ids string")
    folded = map_batches(blocks.repartition("leaf").sortWithinPartitions("leaf", "first"), _digest_blocks,
                         "m long, n long, ends string")
    return folded.join(members.withColumnRenamed("conv_id", "m"), "m")


# --- bursting -----------------------------------------------------------------------------

def burst(strings: DataFrame, max_strings: int) -> tuple[DataFrame, DataFrame]:
    """(heads, lodged): the burst prefixes with depth, members ``n``, smallest
    member ``m`` and last size; and per string that lies below a second head
    the number of heads on its path (all others lie right below the root)."""
    heads, lodged = None, None
    todo, low, step = strings.select("m", "n", "path", "sizes"), 0, 2
    while True:
        levels = todo.select("m", "n", F.posexplode(F.arrays_zip(
            F.slice("path", low + 1, step).alias("node"), F.slice("sizes", low + 1, step).alias("size"))).alias("at", "e"))
        rows = levels.select("m", "n", (F.col("at") + low).alias("depth"), "e.node", "e.size")
        counted = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("strings"), F.min("depth").alias("depth"), F.sum("n").alias("n"), F.min("m").alias("m"),
            F.max("size").alias("size"))
        new = materialize(counted.where((F.col("strings") > max_strings) | (F.col("depth") == 0)).drop("strings"), "trie-heads")
        heads = new if heads is None else heads.unionByName(new)
        below = new.where(F.col("depth") > 0)
        on_path = (rows.select("m", "node").join(below.select("node"), "node").groupBy("m")
                   .agg(F.count(F.lit(1)).alias("heads")))
        lodged = on_path if lodged is None else lodged.unionByName(on_path)
        low, last = low + step, new.where(F.col("depth") == low + step - 1).select("node")
        if last.isEmpty():
            break
        deeper = todo.where(F.size("path") > low).withColumn("node", F.element_at("path", low))
        todo = materialize(deeper.join(last, "node", "left_semi").drop("node"), "trie-burst")
        step *= 2
    return heads, lodged.groupBy("m").agg((F.sum("heads") + 1).cast("int").alias("heads"))


# --- the sweep ------------------------------------------------------------------------------

class _Node:
    __slots__ = ("id", "depth", "size", "m", "n", "children", "leaves", "saved", "ends", "closed")

    def __init__(self, node: bytes, depth: int, size: int):
        self.id, self.depth, self.size = node, depth, size
        self.m, self.n, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, None
        self.closed: list[tuple] = []


EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SWEPT = {"conv_id": ("long", pa.int64()), "depth": ("long", pa.int64()), "parent_conv_id": ("long", pa.int64()),
         "n_convs": ("long", pa.int64()), "n_children": ("long", pa.int64()), "n_leaves": ("long", pa.int64()),
         "saved_tokens": ("long", pa.int64()), "ends_sha256": ("string", pa.string()), "node": ("binary", pa.binary()),
         "above": ("array<binary>", pa.list_(pa.binary()))}
SWEPT_SCHEMA = ", ".join(f"{name} {kind}" for name, (kind, _) in SWEPT.items())


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted strings of containers to nodes.  ``above`` holds the heads over
    a container's root, and is null for the nodes below it."""
    rows: list[tuple] = []
    stack: list[_Node] = []
    container, above = None, None

    def close(keep: int) -> None:
        """Close the open nodes below the first ``keep``."""
        while len(stack) > keep:
            node = stack.pop()
            if not node.children:
                node.leaves = 1
            node.saved += (node.n - 1) * node.size
            rows.extend((m, d, node.m, *rest, None) for m, d, *rest in node.closed)
            row = (node.m, node.depth, node.n, node.children, node.leaves, node.saved, node.ends or EMPTY_SHA, node.id)
            if stack:
                up = stack[-1]
                up.n += node.n
                up.m = node.m if up.m is None else min(up.m, node.m)
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
                up.closed.append(row)
            else:
                rows.append((*row[:2], None, *row[2:], above))

    def batches_of(least: int) -> Iterator[pa.RecordBatch]:
        while len(rows) > least:
            columns = list(zip(*rows[:OUT_ROWS]))
            del rows[:OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, SWEPT.values())], names=list(SWEPT))

    for batch in batches:
        for s in batch.to_pylist():
            heads, path = s["heads"], s["path"]
            shared = 0
            if s["container"] != container:
                close(0)
                container, above = s["container"], path[:heads]
            else:
                most = min(len(stack), len(path) - heads)
                while shared < most and stack[shared].id == path[heads + shared]:
                    shared += 1
                close(shared)
            for d in range(heads + shared, len(path)):
                stack.append(_Node(path[d], d, s["sizes"][d]))
            last = stack[-1]
            last.m, last.n, last.ends = s["m"], s["n"], s["ends"]
            yield from batches_of(OUT_ROWS)
    close(0)
    yield from batches_of(0)


# --- the whole trie -------------------------------------------------------------------------

NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(seqs: DataFrame, max_strings: int = MAX_STRINGS) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv_id, turns), one row each:
    ``conv_id`` its smallest member, ``depth``, ``parent_conv_id``, members, children,
    leaves below (itself, if it is one), the code points that a prefix cache
    saves in its subtree, the digest of the ids of the conversations that end in it,
    and the node's id."""
    strings = materialize(strings_of(materialize(paths_of(seqs), "trie-members")), "trie-strings")
    heads, lodged = burst(strings, max_strings)
    placed = (strings.join(lodged, "m", "left").withColumn("heads", F.coalesce("heads", F.lit(1))))
    inside = placed.where(F.col("heads") < F.size("path")).withColumn("container", F.element_at("path", F.col("heads") + 1))
    ended = placed.where(F.col("heads") >= F.size("path")).select(F.element_at("path", -1).alias("node"), "ends")
    swept = materialize(map_batches(inside.repartition("container").sortWithinPartitions("container", "path"), _sweep,
                                    SWEPT_SCHEMA), "trie-nodes")
    tops = swept.where(F.col("above").isNotNull())

    # a head's path is that of its smallest member
    placed_heads = materialize(
        heads.join(strings.select("m", "path"), "m")
        .select("node", "depth", "n", "m", ((F.col("n") - 1) * F.col("size")).alias("own"),
                F.slice("path", F.lit(1), F.col("depth")).alias("above")), "trie-placed-heads")

    def shares(df: DataFrame, leaves: Column, saved: Column) -> DataFrame:
        """What a subtree adds to every head above it."""
        up = df.select(F.size("above").alias("of"), leaves.alias("leaves"), saved.alias("saved"),
                       F.posexplode("above").alias("at", "node"))
        return up.select("node", "leaves", "saved", (F.col("at") == F.col("of") - 1).cast("long").alias("children"))

    added = (shares(tops, F.col("n_leaves"), F.col("saved_tokens"))
             .unionByName(shares(placed_heads, F.lit(0).cast("long"), F.col("own")))
             .groupBy("node").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")]))
    zero = F.lit(0).cast("long")
    children = F.coalesce("children", zero)
    parents = placed_heads.select(F.col("node").alias("parent"), F.col("m").alias("parent_conv_id"))
    head_nodes = (placed_heads.join(added, "node", "left").join(ended, "node", "left")
                  .withColumn("parent", F.when(F.col("depth") > 0, F.element_at("above", -1)))
                  .join(parents, "parent", "left")
                  .select(F.col("m").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id",
                          F.col("n").alias("n_convs"), children.alias("n_children"),
                          F.when(children == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"),
                          (F.col("own") + F.coalesce("saved", zero)).alias("saved_tokens"),
                          F.coalesce("ends", F.lit(EMPTY_SHA)).alias("ends_sha256"), "node"))
    top_nodes = (tops.drop("parent_conv_id").withColumn("parent", F.element_at("above", -1))
                 .join(parents, "parent").select(*NODE_COLUMNS, "node"))
    return (swept.where(F.col("above").isNull()).select(*NODE_COLUMNS, "node")
            .unionByName(top_nodes).unionByName(head_nodes))
