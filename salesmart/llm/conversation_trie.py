"""The prefix trie of conversations: what shared beginnings would save if they were stored once.

Conversations are sequences of turn hashes, sorted by range over all tasks, so that those with a
common beginning stand together. Each task writes the trie of its shard as balanced parentheses
(``parens``): ``findclose`` gives every node's subtree, counting ``()`` its leaves, and differences
of cumulative arrays its conversations and savings.

Only the nodes on a shard's first and last path can have members elsewhere. They leave the shard as
partial sums, a shard's spine, and the spines of all shards, in shard order, are merged in one pass
with a stack as deep as the path; that pass reads two paths per shard and no conversation.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.arrays import smallest
from salesmart.llm.common import python_tasks
from salesmart.llm.parens import Parens
from salesmart.session import materialise

TOKEN = 32  # bytes of a turn's hash
SHARD_TURNS = 1_000_000  # a task's shard is closed at this size, which bounds its memory
GROUP, HEADS = 100, 6
NOBODY = hashlib.sha256().hexdigest()
ROOT = hashlib.sha256(b"root").digest()


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, key, sizes``: the rebuilt conversations, turn by turn as hash and code points.

    A conversation starts with the first turns of the first one of its hundred, as many as its id's
    crc32 says, and goes on with its own turns after these. Texts do not travel.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    token = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), token.alias("token"), F.length(text).alias("size")).alias("turn"),
    ).filter("conv_id IS NOT NULL")
    sequences = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    sequences = sequences.select("conv_id", F.transform("turns", lambda t: F.struct(t["token"].alias("token"), t["size"].alias("size"))).alias("turns"))
    sequences = materialise(sequences, "conversations")
    first = sequences.filter(f"conv_id % {GROUP} = 0").select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, HEADS - 1).alias("_head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    whole = sequences.join(first, F.expr(f"conv_id - conv_id % {GROUP}") == F.col("_first"), "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("_head", F.lit(1), h), F.slice("turns", 1, 0)),
            F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(0))),
        ).alias("turns"),
    )
    return materialise(
        whole.select(
            "conv_id",
            F.unhex(F.array_join(F.transform("turns", lambda t: t["token"]), "")).alias("key"),
            F.transform("turns", lambda t: t["size"]).alias("sizes"),
        ),
        "rebuilt-conversations",
    )


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TOKEN
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // TOKEN


COLUMNS = {
    **dict.fromkeys(["part", "shard", "pre"], "long"),
    **dict.fromkeys(["digest", "parent_digest"], "binary"),
    **dict.fromkeys(["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "size"], "long"),
    "ends": "string",
}
ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
# What is known of a merged node.
WHOLE = ["digest", "parent_digest", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def schema(names: list[str]) -> str:
    return ", ".join(f"{c} {COLUMNS[c]}" for c in names)


def batch_of(names: list[str], columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, ARROW[COLUMNS[n]]) for n, c in zip(names, columns)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def shard_rows(part: int, shard: int, keys: list[bytes], sizes: list[list[int]], ids: np.ndarray) -> pa.RecordBatch:
    """The nodes of the conversations (sorted by key and id) of one shard.

    Nodes with a ``digest`` are on the spine: of them, children, leaves and savings count what hangs
    from the node itself off the spine, and ``ends`` lists ids. The others are whole, and ``ends`` is its hash.
    """
    bits, depth, size, parent = bytearray(b"\1"), array("q", [0]), array("q", [0]), array("q", [-1])
    path, last, end = [0], b"", array("q")
    for key, own in zip(keys, sizes):
        common, node = common_turns(last, key), len(depth)
        new = len(own) - common
        bits += b"\0" * (len(path) - 1 - common) + b"\1" * new
        if new:
            parent.append(path[common])
            parent.extend(range(node, node + new - 1))
            depth.extend(range(common + 1, len(own) + 1))
            size.extend(own[common:])
        path[common + 1 :] = range(node, node + new)
        end.append(path[-1])
        last = key
    bits += b"\0" * len(path)

    tree = Parens(np.frombuffer(bytes(bits), np.uint8))
    opening = tree.opens()
    closing = tree.findclose(opening)
    n = len(opening)
    first = np.arange(n)
    stop = first + (closing - opening + 1) // 2
    depth, size, parent, end = (np.array(a, np.int64) for a in (depth, size, parent, end))

    def inside(values: np.ndarray) -> np.ndarray:
        """Sums over subtrees, whose nodes are neighbours."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[stop] - total[first]

    ending = np.bincount(end, minlength=n)
    n_convs = inside(ending)
    own = (n_convs - 1) * size
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, end, ids)
    conv_id = smallest(least, first, stop)

    spine = np.zeros(n, bool)
    spine[: len(sizes[0]) + 1] = True
    spine[path] = True
    n_children = np.bincount(parent[1:][~spine[1:]], minlength=n)
    # A spine node counts what hangs from itself; what hangs from spine nodes below is theirs.
    n_leaves = np.where(spine, inside((stop - first == 1) & ~spine), tree.leaf_pairs(opening, closing))
    saved = inside(np.where(spine, 0, own))
    lower = np.flatnonzero(spine)[1:]
    for values in (n_leaves, saved):
        np.subtract.at(values, parent[lower], values[lower])

    digest: list[bytes | None] = [None] * n
    digest[0] = ROOT
    for nodes, key in ((range(1, len(sizes[0]) + 1), keys[0]), (path[1:], keys[-1])):
        for node in nodes:
            d = int(depth[node])
            digest[node] = hashlib.sha256(digest[parent[node]] + key[TOKEN * (d - 1) : TOKEN * d]).digest()
    ends = ["" if s else NOBODY for s in spine]
    stops = np.cumsum(ending)
    for node in np.flatnonzero(ending):
        text = ",".join(map(str, ids[stops[node] - ending[node] : stops[node]].tolist()))
        ends[node] = text if spine[node] else hashlib.sha256(text.encode()).hexdigest()
    above = np.maximum(parent, 0)
    inner = ~spine & ~spine[above]
    columns = [
        np.full(n, part), np.full(n, shard), first, digest, [digest[p] if p >= 0 else None for p in parent], conv_id, depth,
        pa.array(conv_id[above], mask=~inner), n_convs, n_children, n_leaves, saved, size, ends,
    ]
    return batch_of(list(COLUMNS), columns)


def shards(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of all shards, as ``shard_rows`` gives them, written."""
    python_tasks(sequences.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, turns, keys, sizes, ids = 0, 0, 0, [], [], []
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for part, conv_id, key, size in rows:
                keys.append(key)
                sizes.append(size)
                ids.append(conv_id)
                turns += len(size) + 1
                if turns >= shard_turns:
                    yield shard_rows(part, shard, keys, sizes, np.array(ids, np.int64))
                    shard, turns, keys, sizes, ids = shard + 1, 0, [], [], []
        if keys:
            yield shard_rows(part, shard, keys, sizes, np.array(ids, np.int64))

    placed = sequences.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    placed = placed.select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "key", "sizes")
    return materialise(placed.mapInArrow(run, schema(list(COLUMNS))), "trie-shards")


@dataclass
class Spine:
    """A node of the merged spines, while its subtree is read."""

    digest: bytes
    parent_digest: bytes | None
    depth: int
    size: int
    conv_id: int
    n_convs: int = 0
    n_children: int = 0
    n_leaves: int = 0
    saved_tokens: int = 0

    def values(self) -> tuple:
        return self.digest, self.parent_digest, self.conv_id, self.depth, self.n_convs, self.n_children, self.n_leaves, self.saved_tokens


def merged(spines: Iterator[tuple]) -> Iterator[tuple]:
    """The whole nodes of spines that come in the order of their shards, each in its own order."""
    stack: list[Spine] = []

    def close() -> Iterator[tuple]:
        node = stack.pop()
        node.n_leaves += not node.n_children
        node.saved_tokens += (node.n_convs - 1) * node.size
        if stack:
            stack[-1].n_children += 1
            stack[-1].n_leaves += node.n_leaves
            stack[-1].saved_tokens += node.saved_tokens
        yield node.values()

    for digest, parent_digest, conv_id, depth, n_convs, n_children, n_leaves, saved, size in spines:
        if len(stack) <= depth or stack[depth].digest != digest:
            while len(stack) > depth:
                yield from close()
            stack.append(Spine(digest, parent_digest, depth, size, conv_id))
        node = stack[depth]
        node.conv_id = min(node.conv_id, conv_id)
        node.n_convs += n_convs
        node.n_children += n_children
        node.n_leaves += n_leaves
        node.saved_tokens += saved
    while stack:
        yield from close()


def merge_spines(spines: DataFrame) -> DataFrame:
    """One row per node of all spines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for some in batched(merged(rows()), 10_000):
            yield batch_of(WHOLE, list(zip(*some)))

    # Two paths per shard, in one stream.
    ordered = spines.repartition(1).sortWithinPartitions("part", "shard", "pre").select(*WHOLE, "size")
    return materialise(ordered.mapInArrow(run, schema(WHOLE)), "trie-spines")


def hashed_ends(spines: DataFrame) -> DataFrame:
    """``digest, ends``: the hash of the ids that end at a node, over its shards in their order.

    SHA-256 runs through its input from the first byte to the last, so one node's ids go through one
    task, as a stream of one text per shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for digest, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if digest != node:
                    if running:
                        done.append((node, running.hexdigest()))
                    node, running = digest, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ends.encode())
            if done:
                yield batch_of(["digest", "ends"], list(zip(*done)))
        if running:
            yield batch_of(["digest", "ends"], [[node], [running.hexdigest()]])

    rows = spines.filter("ends <> ''").select("digest", "part", "shard", "ends")
    rows = rows.repartition("digest").sortWithinPartitions("digest", "part", "shard").select("digest", "ends")
    return rows.mapInArrow(run, schema(["digest", "ends"]))


def trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``turns``.

    ``turns``: conv_id, turn, role, text; other columns are not read. Turns stand by number, null
    first, equal numbers by role and then by the hash of role and text; a null role or text is empty.
    Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of
    their own. A conversation without turns ends at the root. An empty table has no conversation and
    no node. Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A conversation travels as one row with 40 bytes per turn, whatever its texts.
    """
    nodes = shards(rebuilt(turns), shard_turns)
    spines = nodes.filter("digest IS NOT NULL")
    whole = merge_spines(spines)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]

    # Off the spine; below it the parent's smallest member is looked up, by shard.
    off = nodes.filter("digest IS NULL")
    inner = off.filter("parent_digest IS NULL").select(*out)
    members = whole.select("digest", F.col("conv_id").alias("_parent"))
    known = spines.select("part", "shard", F.col("digest").alias("parent_digest"), "digest").join(members, "digest").drop("digest")
    below = off.filter("parent_digest IS NOT NULL").drop("parent_conv_id").join(known, ["part", "shard", "parent_digest"])
    below = below.withColumnRenamed("_parent", "parent_conv_id").select(*out)

    parents = members.select(F.col("digest").alias("parent_digest"), F.col("_parent").alias("parent_conv_id"))
    on = whole.join(parents, "parent_digest", "left").join(hashed_ends(spines), "digest", "left")
    on = on.withColumn("ends", F.coalesce("ends", F.lit(NOBODY))).select(*out)
    return inner.unionByName(below).unionByName(on)
