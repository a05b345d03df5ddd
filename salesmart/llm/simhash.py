"""SimHash near-dedup by segment popcounts.

A fingerprint's 32 segments of two bits are mapped to their bit counts. The Manhattan distance of
two such vectors never exceeds the Hamming distance of the fingerprints. Counts 0, 1, 2 are kept
as the bits 00, 01, 11, so that the Manhattan distance is the number of differing bits.

The range join: the 32 axes form 8 groups. Vectors within a distance of 4 agree in at least 4 whole
groups, so each of the 70 choices of 4 groups is a grid whose cells are the vectors' values on
these axes, and a pair within reach shares a cell in one of them. In a cell the Manhattan distance
is tested first, then the Hamming distance.

Fingerprints are joined, not documents: copies are one fingerprint. Cells are sorted runs of rows
that stream through a task; one with many members gives a spanning forest, found by searching from
member to member among those not yet reached, and not its pairs. A cell with over ``CELL`` members is
not searched but passed on, and its members are dealt again by their bits: fingerprints within 4 bits
agree in 4 of 8 bytes, so they share one of 70 finer cells. Should one of these still be too large,
its members are dealt into parts of about ``CELL``, and every two parts meet in a task of their
own. So no task holds more than a part or two, and the search of a cell is bounded. Links become
components by alternating large-star and small-star steps, each written to shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmart.llm.common import python_tasks
from salesmart.session import materialise

SEED = 42
GROUPS = 8
PAIRWISE = 16
CELL = 4096
PAIRS = np.uint64(0x5555555555555555)


def shingle_hashes(text: str | None, width: int) -> list[int]:
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if len(words) <= width:
        return [xxh64_intdigest(b" ".join(words), SEED)] if words else []
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    flat, stops = b" ".join(words), (ends - 1).tolist()
    return [xxh64_intdigest(flat[a:b], SEED) for a, b in zip(starts, stops[width - 1 :])]


def fingerprints_of(texts: list[str | None], width: int) -> np.ndarray:
    hashes = [shingle_hashes(t, width) for t in texts]
    counts = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        flat = np.array([x for h in hashes for x in h], "<u8")
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        firsts = np.cumsum(counts[some]) - counts[some]
        ones = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > counts[some, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` (longs) for every row of ``docs`` (doc_id, text)."""
    python_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(batch.column(2).to_pylist(), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found)], names=["doc_id", "text_hash", "fingerprint"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fingerprint long")


def popcounts(x: np.ndarray) -> np.ndarray:
    """The bit counts of the two-bit segments, 0, 1, 2 as 00, 01, 11."""
    low, high = x & PAIRS, (x >> np.uint64(1)) & PAIRS
    return (low | high) | ((low & high) << np.uint64(1))


def grids(max_bits: int) -> list[np.uint64]:
    """Masks of the axes of each grid: groups that agree if at most ``max_bits`` axes differ."""
    if not 0 <= max_bits < GROUPS:
        raise ValueError(f"max_bits must be from 0 to {GROUPS - 1}")
    width = 64 // GROUPS
    return [
        np.uint64(sum(((1 << width) - 1) << (width * g) for g in chosen))
        for chosen in combinations(range(GROUPS), GROUPS - max_bits)
    ]


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    near = np.bitwise_count(popcounts(a) ^ popcounts(b)) <= max_bits
    near[near] = np.bitwise_count(a[near] ^ (b[near] if b.ndim else b)) <= max_bits
    return near


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[np.uint64, np.uint64]]:
    """Links that connect all members that the full set of links connects."""
    rest, links = members, []
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = _linked(rest, np.asarray(at), max_bits)
            found, rest = rest[near], rest[~near]
            links += [(at, x) for x in found]
            reached += list(found)
    return links


def cell_links(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the cells of rows that are sorted by cell."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    size = np.repeat(sizes, sizes)
    left, right = [], []
    for step in range(1, min(PAIRWISE, int(sizes.max(initial=1)))):
        pair = np.flatnonzero((keys[:-step] == keys[step:]) & (size[:-step] <= PAIRWISE))
        pair = pair[_linked(prints[pair], prints[pair + step], max_bits)]
        left.append(prints[pair])
        right.append(prints[pair + step])
    for cell in np.flatnonzero(sizes > PAIRWISE):
        links = _forest(prints[starts[cell] : starts[cell] + sizes[cell]], max_bits)
        if links:
            a, b = zip(*links)
            left.append(np.array(a, np.uint64))
            right.append(np.array(b, np.uint64))
    empty = [np.zeros(0, np.uint64)]
    return np.concatenate(empty + left), np.concatenate(empty + right)


def _mixed(key: np.ndarray) -> np.ndarray:
    key = key * np.uint64(0x9E3779B97F4A7C15)
    return key ^ key >> np.uint64(32)


def _dealt(rows: DataFrame, max_bits: int, vector: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``cell, fingerprint``: each fingerprint once for every choice of groups of its ``vector``.

    The cell that rows come in, if any, is part of the new one.
    """
    masks = grids(max_bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            inside = batch.column(1).to_numpy().view(np.uint64)
            of = vector(x)
            for n, mask in enumerate(masks):
                key = _mixed((of & mask) ^ np.uint64(n * 0x0101010101010101))
                key = np.where(inside != 0, _mixed(key ^ inside), key)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0)], names=["cell", "fingerprint"])

    return rows.mapInArrow(deal, "cell long, fingerprint long")


def _searched(cells: DataFrame, keys: list[str], max_bits: int, cell: int | None, name: str) -> tuple[DataFrame, DataFrame]:
    """The links within each cell, and the members of cells with over ``cell`` of them, written."""
    schema = "a long, b long, large boolean"

    def batch_of(a: np.ndarray, b: np.ndarray, large: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), large))], names=["a", "b", "large"])

    def linked(keys_: np.ndarray, prints_: np.ndarray) -> pa.RecordBatch:
        a, b = cell_links(keys_, prints_, max_bits)
        a, b = a.view(np.int64), b.view(np.int64)
        return batch_of(np.minimum(a, b), np.maximum(a, b), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_, prints_ = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        passed = None  # the cell that is being passed on
        for batch in batches:
            if not len(batch):
                continue
            keys_ = np.concatenate([keys_, batch.column(0).to_numpy()])
            prints_ = np.concatenate([prints_, batch.column(1).to_numpy().view(np.uint64)])
            if passed is not None:
                n = int(np.searchsorted(keys_ != passed, True))
                if n:
                    yield batch_of(keys_[:n], prints_[:n].view(np.int64), True)
                    keys_, prints_ = keys_[n:], prints_[n:]
                if len(keys_):
                    passed = None
            if not len(keys_):
                continue
            if cell is not None:
                starts = np.flatnonzero(np.concatenate([[True], keys_[1:] != keys_[:-1]]))
                sizes = np.diff(np.append(starts, len(keys_)))
                large = np.repeat(sizes > cell, sizes)
                if large.any():
                    yield batch_of(keys_[large], prints_[large].view(np.int64), True)
                    passed = int(keys_[-1]) if large[-1] else None
                    keys_, prints_ = keys_[~large], prints_[~large]
                    if not len(keys_):
                        continue
            # The last cell may go on in the next batch.
            rest = 0 if passed is not None else int(np.searchsorted(keys_[::-1] != keys_[-1], True))
            if len(keys_) - rest > 100_000:
                cut = len(keys_) - rest
                yield linked(keys_[:cut], prints_[:cut])
                keys_, prints_ = keys_[cut:], prints_[cut:]
        if len(keys_):
            yield linked(keys_, prints_)

    sorted_ = cells.repartition(*keys).sortWithinPartitions(*keys)
    one = sorted_.select((F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)).alias("cell"), "fingerprint")
    found = materialise(one.mapInArrow(run, schema), name)
    large = found.filter("large").select(F.col("b").alias("fingerprint"), F.col("a").alias("cell"))
    return found.filter("NOT large").select("a", "b"), large


def links(prints: DataFrame, max_bits: int = 4, cell: int = CELL) -> DataFrame:
    """``a, b`` with a < b: links that connect the same fingerprints as all links together.

    ``prints``: distinct fingerprints, column ``fingerprint``.
    """
    python_tasks(prints.sparkSession)
    rows = prints.select("fingerprint", F.lit(0).cast("long").alias("cell"))
    first, large = _searched(_dealt(rows, max_bits, popcounts), ["cell"], max_bits, cell, "links-grid")
    if large.isEmpty():
        return first.distinct()
    fine = _dealt(large, max_bits, lambda x: x)
    second, larger = _searched(fine, ["cell"], max_bits, cell, "links-bits")
    found = first.unionByName(second)
    if not larger.isEmpty():
        sizes = larger.groupBy("cell").agg(F.count("*").alias("n"))
        parts = F.expr(f"CAST((n - 1) div {cell} + 1 AS INT)")
        dealt = larger.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("fingerprint"), parts).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        pairs = dealt.select("cell", F.least("part", "other").alias("lower"), F.greatest("part", "other").alias("upper"), "fingerprint")
        third, _ = _searched(pairs, ["cell", "lower", "upper"], max_bits, None, "links-parts")
        found = found.unionByName(third)
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b) but the roots; a root is its smallest node.

    Alternates large-star and small-star until nothing changes: the number of rounds follows the
    logarithm of the longest path. Joins have one row per node on one side.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # From here on a > b: b is the nearer to the root.
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .filter(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = materialise(small, "small-star")
        after = state(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id, text_hash, root`` for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links of at most ``max_bits`` differing bits
    reach, ``root`` the fingerprint that names the component. A text of fewer than ``width`` words has
    one shingle, all of it; one without words, or null, has the fingerprint zero and is linked like any
    other; of a very long one all shingles count. A null doc_id is never the smallest unless all are
    null. Repeated rows give a row each. An empty table gives an empty result. Other columns are not
    read.
    """
    found = materialise(fingerprints(docs, width), "fingerprints")
    distinct = materialise(
        found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints"
    )
    roots = distinct.join(
        components(links(distinct, max_bits)).withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = roots.join(smallest, "root").select("fingerprint", "component_id", "root")
    return found.join(member, "fingerprint").select("doc_id", "fingerprint", "component_id", "text_hash", "root")


def one_of_each(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """One whole row of ``docs`` (doc_id, text and any others) per component.

    The row with the smallest doc_id, one without an id only if no row of the component has one;
    among equal ids the text with the smallest hash; of equal ids and texts any row.
    """
    found = materialise(near_duplicates(docs, width, max_bits), "components")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "n"))
    chosen = rows.groupBy("root").agg(first.alias("r")).select(
        F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_hash"), F.col("r.n").alias("_n")
    )
    chosen = materialise(chosen, "kept")

    def of(kept: DataFrame) -> DataFrame:
        text = docs["text"].cast("string")
        same = docs["doc_id"].cast("long").eqNullSafe(kept["_id"]) & (F.xxhash64(text) == kept["_hash"])
        return docs.join(kept, same, "left_semi")

    # Rows that repeat a kept one are few or none: only these are grouped.
    repeated = of(chosen.filter("_n > 1")).withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    return of(chosen.filter("_n = 1")).unionByName(repeated.dropDuplicates(["doc_id", "_hash"]).drop("_hash"))


def as_hex(fingerprint: str = "fingerprint"):
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
