"""Merkle manifest of a data set: a tree of hashes over all rows, with a proof for each row.

The leaves of a group (a language) stand in the order of their ids; every ``ARITY`` consecutive
nodes become their hash until one is left, the group's root, and the roots of all groups make the
data set's root in the same way.

The tree is built in aligned blocks of ``ARITY ** levels`` nodes, each one bounded task's work: the
roots of the blocks are the nodes of the next round, so the rounds follow the logarithm of the number
of rows. A block is persistent: putting another hash in place of a leaf copies the leaf's
ancestors and shares every other node, so a version costs ``levels`` hashes and the original
stays as it is. A version's block root continues through the siblings of the block's path, which the
upper rounds hand down block by block; no task sees all versions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import lower_ascii, python_tasks
from salesmart.llm.ranks import numbered
from salesmart.session import materialise

ARITY = 8
LEVELS = 4

# Siblings to the left and to the right of a node, one text of joined hashes per level, bottom up.
PATH = "lefts array<string>, rights array<string>"


def digest(parts: Iterator[str] | list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


@dataclass(frozen=True)
class Version:
    """A block with one leaf replaced: the copied ancestors of that leaf; all else is shared."""

    block: Block
    copied: tuple[str, ...]

    @property
    def root(self) -> str:
        return self.copied[-1]

    def node(self, level: int, at: int, leaf: int) -> str:
        return self.copied[level] if leaf // ARITY**level == at else self.block.levels[level][at]


@dataclass(frozen=True)
class Block:
    """The nodes of an aligned part of a tree, level by level from its leaves to its root."""

    levels: list[list[str]]

    @classmethod
    def build(cls, leaves: list[str], n: int, most: int) -> Block:
        """``n``: nodes of the whole tree on the leaves' level; at most ``most`` levels above."""
        levels = [leaves]
        for _ in range(min(most, height(n))):
            below = levels[-1]
            levels.append([digest(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
        return cls(levels)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, leaf: int) -> tuple[list[str], list[str]]:
        """The siblings of a leaf's path."""
        lefts, rights = [], []
        for nodes in self.levels[:-1]:
            first = leaf - leaf % ARITY
            lefts.append("".join(nodes[first:leaf]))
            rights.append("".join(nodes[leaf + 1 : first + ARITY]))
            leaf //= ARITY
        return lefts, rights

    def put(self, leaf: int, new: str) -> Version:
        copied, at = [new], leaf
        for nodes in self.levels[:-1]:
            first = at - at % ARITY
            copied.append(digest([*nodes[first:at], copied[-1], *nodes[at + 1 : first + ARITY]]))
            at //= ARITY
        return Version(self, tuple(copied))


def fold(node: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a node and the siblings of its path give."""
    for left, right in zip(lefts, rights):
        node = digest([left, node, right])
    return node


def blocks(nodes: DataFrame, most: int, name: str) -> DataFrame:
    """``tree, block, n, leaves, root``: the nodes (tree, idx, n, node) in aligned blocks, written.

    Only the struct ``node`` with its text ``hash`` is read; what else it has stays with the leaves.
    """
    members = F.sort_array(F.collect_list(F.struct("idx", "node")))
    grouped = (
        nodes.groupBy("tree", F.expr(f"idx div {ARITY**most}").alias("block"))
        .agg(members.alias("members"), F.first("n").alias("n"))
        .select("tree", "block", "n", F.transform("members", lambda m: m["node"]).alias("leaves"))
    )
    python_tasks(nodes.sparkSession)

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(4).to_pylist(), batch.column(2).to_pylist())
            root = [Block.build(hashes, n, most).root for hashes, n in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(root, pa.string())], names=["tree", "block", "n", "leaves", "root"]
            )

    hashed = grouped.withColumn("hashes", F.transform("leaves", lambda m: m["hash"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in grouped.schema.fields)
    return materialise(hashed.mapInArrow(roots, f"{schema}, root string"), name)


def rounds(nodes: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The blocks of every round, until each tree is one block."""
    found = [blocks(nodes, most, f"{name}-0")]
    while (found[-1].agg(F.max("n")).first()[0] or 0) > ARITY**most:
        last = found[-1].select(
            "tree",
            F.col("block").alias("idx"),
            F.expr(f"(n - 1) div {ARITY**most} + 1").alias("n"),
            F.struct(F.col("root").alias("hash")).alias("node"),
        )
        found.append(blocks(last, most, f"{name}-{len(found)}"))
    return found


def with_paths(held: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the siblings of their own path to the top: ``lefts, rights``."""
    above = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "lefts", "rights")
    same = held["tree"].eqNullSafe(above["_tree"]) & (held["block"] == above["_block"])
    return held.join(above, same).drop("_tree", "_block")


def hand_down(held: DataFrame, paths: DataFrame, most: int) -> DataFrame:
    """``tree, block, lefts, rights`` of the nodes of upper blocks, which are the blocks below."""
    python_tasks(held.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.build(row["hashes"], row["n"], most)
                found = [block.path(i) for i in range(len(row["hashes"]))]
                first = row["block"] * ARITY**most
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(found), pa.string()),
                        pa.array([first + i for i in range(len(found))], pa.int64()),
                        pa.array([lefts + row["lefts"] for lefts, _ in found], pa.list_(pa.string())),
                        pa.array([rights + row["rights"] for _, rights in found], pa.list_(pa.string())),
                    ],
                    names=["tree", "block", "lefts", "rights"],
                )

    rows = with_paths(held, paths).select(
        "tree", "block", "n", F.transform("leaves", lambda m: m["hash"]).alias("hashes"), "lefts", "rights"
    )
    return rows.mapInArrow(run, f"tree string, block long, {PATH}")


def down(held: list[DataFrame], paths: DataFrame, most: int) -> DataFrame:
    """The paths of the lowest round's blocks."""
    for upper in reversed(held[1:]):
        paths = hand_down(upper, paths, most)
    return paths


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The hash of a row of documents with ``text`` as its text."""
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long"), text]
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``doc_id, lang, idx, leaf, subroot, root, proof, tampered, folded_root, verified`` per row.

    ``docs``: doc_id, source, lang, n_chars, text; other columns are not read. Rows of a language
    stand by doc_id, null first; rows with equal ids by their hash. Null columns hash as ``-``.
    ``proof`` is the hash of all siblings on the way to the root. Every row whose doc_id's crc32 is
    divisible by 3 is tampered with by itself (its text in lower case, a null text as it is, so that
    it verifies); ``folded_root`` is the root of that version of the tree, for other rows the
    root folded from their own proof. Repeated rows are leaves of their own. An empty table has no
    rows and no root. Texts are hashed where they are read and do not travel.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    leaves = docs.select(
        F.col("lang").cast("string").alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(text).alias("hash"),
        F.when(changed, leaf(lower_ascii(text))).alias("other"),
    )
    # Sorting by range reads its input twice.
    leaves = materialise(leaves, "merkle-hashes")
    placed = numbered(leaves, ["tree"], ["doc_id", "hash"], "merkle-leaves")
    low = rounds(placed.select("tree", "idx", "n", F.struct("hash", "doc_id", "other").alias("node")), levels, "merkle")
    tops = low[-1].select(F.col("tree").alias("lang"), F.lit("").alias("tree"), "root")
    ranked = numbered(tops, ["tree"], ["lang"], "merkle-languages")
    high = rounds(ranked.select("tree", "idx", "n", F.struct(F.col("root").alias("hash"), "lang").alias("node")), levels, "merkle-top")
    top = high[-1].first()  # one block, none for an empty table

    start = high[-1].select("tree", "block", *[F.array().cast("array<string>").alias(c) for c in ("lefts", "rights")])
    ends = down(high, start, levels)
    languages = hand_down(high[0], ends, levels).withColumnRenamed("block", "idx").drop("tree")
    subroots = ranked.select(F.col("lang").alias("tree"), F.col("root").alias("subroot"), "idx").join(languages, "idx")
    subroots = materialise(subroots.withColumn("all_root", F.lit(top and top["root"]).cast("string")), "merkle-subroots")

    paths = down(low, subroots.select("tree", F.lit(0).cast("long").alias("block"), "lefts", "rights"), levels)
    held = with_paths(low[0], paths)
    tree = subroots.select(F.col("tree").alias("_lang"), "subroot", "all_root")
    held = held.join(tree, held["tree"].eqNullSafe(tree["_lang"]))
    rows = held.select("tree", "block", "n", "leaves", "lefts", "rights", "subroot", "all_root")
    python_tasks(spark)

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.build([m["hash"] for m in row["leaves"]], row["n"], levels)
                out = []
                for i, m in enumerate(row["leaves"]):
                    lefts, rights = block.path(i)
                    lefts, rights = lefts + row["lefts"], rights + row["rights"]
                    proof = digest(x for pair in zip(lefts, rights) for x in pair)
                    if m["other"] is None:
                        folded = fold(m["hash"], lefts, rights)
                    else:
                        folded = fold(block.put(i, m["other"]).root, row["lefts"], row["rights"])
                    out.append((m["doc_id"], row["block"] * ARITY**levels + i, m["hash"], proof, m["other"] is not None, folded))
                doc_id, idx, hashes, proofs, tampered, folded = zip(*out)
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_id, pa.int64()),
                        pa.array([row["tree"]] * n, pa.string()),
                        pa.array(idx, pa.int64()),
                        pa.array(hashes),
                        pa.array([row["subroot"]] * n),
                        pa.array([row["all_root"]] * n),
                        pa.array(proofs),
                        pa.array(tampered),
                        pa.array(folded),
                        pa.array([f == row["all_root"] for f in folded]),
                    ],
                    names=["doc_id", "lang", "idx", "leaf", "subroot", "root", "proof", "tampered", "folded_root", "verified"],
                )

    return rows.mapInArrow(
        prove,
        "doc_id long, lang string, idx long, leaf string, subroot string, root string, proof string, "
        "tampered boolean, folded_root string, verified boolean",
    )
