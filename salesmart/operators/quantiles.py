"""Exact order statistics of many integer-like columns without a global sort.

A value is found by narrowing a bracket. Every pass counts the rows of each bracket in at most
``FANOUT`` equal slices (counted on the map side) and keeps the slice that holds the wanted
rank, until a slice is one value wide. No pass shuffles rows, and no task ever sees more than
``FANOUT`` counters per bracket, whatever the distribution.

The first bracket is all values, or one that a sketch proposes. A proposed bracket holds only a small
part of the rows, and usually so few values that one pass is enough; the number of rows below it is
counted, and a rank that is not in it after all is looked for among all values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from salesmart.session import materialise

FANOUT = 1 << 16


Bracket = tuple[int, int]


@dataclass(frozen=True)
class _Search:
    """Looks for one rank of one column: ``skip`` rows into the values from ``lo`` to ``hi``."""

    ord: int
    rank: int
    skip: int
    lo: int
    hi: int

    @property
    def width(self) -> int:
        return -(-(self.hi - self.lo + 1) // FANOUT)


def order_statistics(
    values_of: Callable[[Mapping[int, set[Bracket]]], DataFrame],
    spans: Mapping[int, Bracket],
    ranks: Iterable[tuple[int, int]],
    guesses: Mapping[tuple[int, int], Bracket] | None = None,
    below: Callable[[Iterable[tuple[int, int]]], Mapping[tuple[int, int], int]] | None = None,
) -> dict[tuple[int, int], int]:
    """Values at 0-based ``ranks``, pairs of column number and rank.

    ``values_of`` gives the rows ``(ord, v)`` of the columns asked for, ``v`` a bigint that is
    not NULL; it may leave out values beyond the brackets it is told of each column; ``spans`` are the smallest and largest value per column number. ``guesses`` are
    brackets that probably hold a rank; ``below`` then counts a column's values below others. A
    pass brings one row per rank to the driver, and columns that are done are not read again.
    """
    wanted = sorted(set(ranks))
    guesses = guesses or {}
    before = below({(ord_, guesses[ord_, rank][0]) for ord_, rank in wanted if (ord_, rank) in guesses}) if below and guesses else {}

    def first(ord_: int, rank: int) -> _Search:
        lo, hi = guesses.get((ord_, rank), spans[ord_])
        skip = rank - before[ord_, lo] if (ord_, rank) in guesses else rank
        return _Search(ord_, rank, skip, lo, hi) if skip >= 0 else _Search(ord_, rank, rank, *spans[ord_])

    open_ = [first(*w) for w in wanted]
    found: dict[tuple[int, int], int] = {}
    while open_:
        following = []
        wanted_now = {s.ord: {(t.lo, t.hi) for t in open_ if t.ord == s.ord} for s in open_}
        held = _pass(values_of(wanted_now), open_)
        for search in open_:
            if search not in held:  # beyond the guessed bracket
                following.append(_Search(search.ord, search.rank, search.rank, *spans[search.ord]))
                continue
            slot, less = held[search]
            lo = search.lo + slot * search.width
            if search.width == 1:
                found[search.ord, search.rank] = lo
            else:
                hi = min(search.hi, lo + search.width - 1)
                following.append(_Search(search.ord, search.rank, search.skip - less, lo, hi))
        open_ = following
    return found


def _pass(values: DataFrame, searches: list[_Search]) -> dict[_Search, tuple[int, int]]:
    """Per search the slice that holds its rank, and the number of bracket rows before it."""
    spark = values.sparkSession
    brackets = spark.createDataFrame(
        sorted({(s.ord, s.lo, s.hi, s.width) for s in searches}), "ord int, lo long, hi long, width long"
    )
    targets = spark.createDataFrame(
        [(s.ord, s.lo, s.hi, s.rank, s.skip) for s in searches], "ord int, lo long, hi long, rnk long, skip long"
    )
    # The difference of two bigints may need one more bit.
    long = any(s.hi - s.lo >= 1 << 63 for s in searches)
    slot = "(CAST(v AS DECIMAL(20,0)) - lo) div width" if long else "(v - lo) div width"
    # Both local frames have a row per search at most. Few rows pass a narrow bracket.
    counted = (
        values.join(F.broadcast(brackets), (values["ord"] == brackets["ord"]) & values["v"].between(brackets["lo"], brackets["hi"]))
        .select(brackets["ord"], "lo", "hi", F.expr(slot).cast("long").alias("slot"))
        .groupBy("ord", "lo", "hi", "slot")
        .agg(F.count("*").alias("n"))
    )
    up_to = Window.partitionBy("ord", "lo", "hi").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    held = (
        counted.withColumn("below", F.sum("n").over(up_to) - F.col("n"))
        .join(F.broadcast(targets), ["ord", "lo", "hi"])
        .filter("skip >= below and skip < below + n")
        .select("ord", "rnk", "slot", "below")
        .collect()
    )
    by_rank = {(s.ord, s.rank): s for s in searches}
    return {by_rank[r.ord, r.rnk]: (r.slot, r.below) for r in held}


def sorted_values(values: DataFrame, ranks: Iterable[int]) -> dict[int, object]:
    """Values at 0-based ``ranks`` of the column ``v`` of any ordered type, without nulls.

    Equal values are counted first, so a frequent value is one row; the distinct ones are dealt
    by range. One row per partition and one per rank come to the driver.
    """
    counted = values.groupBy("v").agg(F.count("*").alias("n"))
    dealt = materialise(
        counted.repartitionByRange("v").select("v", "n", F.spark_partition_id().alias("part")), "sorted-values"
    )
    sizes = {r.part: r.n for r in dealt.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    if not before:
        return {}
    wanted = sorted(set(ranks))
    starts = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    up_to = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("end", F.element_at(starts, F.col("part")) + F.sum("n").over(up_to))
    held = F.filter(
        F.array(*[F.lit(r).cast("long") for r in wanted]), lambda r: (r >= F.col("end") - F.col("n")) & (r < F.col("end"))
    )
    return {r.rank: r.v for r in placed.select("v", F.explode(held).alias("rank")).collect()}
