"""Duplicate rows and duplicate business keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.session import materialise

EXAMPLES = 10

# Repeated hashes sent to all tasks: at most 8 MB.
SENT = 1 << 20


def hash_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_h, n``: the hashes of eight bytes that several rows share, and their rows; written.

    The rows with a hash of their own, which are unique, are one group without a hash.
    """
    per_hash = df.groupBy(F.xxhash64(*columns).alias("_h")).agg(F.count("*").alias("n"))
    grouped = per_hash.groupBy(F.when(F.col("n") > 1, F.col("_h")).alias("_h")).agg(F.sum("n").alias("n"))
    return materialise(grouped, "row-hashes")


def duplicate_groups(
    df: DataFrame, columns: Sequence[str], hashes: DataFrame | None = None, dealt: bool = False
) -> DataFrame:
    """Values of ``columns`` that occur more than once, with ``n``; NULL equals NULL.

    Rows are first grouped by their hash, and the repeated hashes are stored, so that their number
    is known. Up to ``SENT`` of them go to all tasks as a filter, and only rows with a repeated hash
    are shuffled and compared in full. Beyond that all rows meet the hashes in a join. ``df`` is
    evaluated twice.

    With ``dealt`` the rows are known to come out of a shuffle by some of ``columns``, such as a join
    leaves them. Equal rows then lie in one task, and are compared there without another shuffle.
    """
    columns = list(columns)
    if dealt:
        return _counted(df, columns).filter("n > 1")
    hashes = hash_groups(df, columns) if hashes is None else hashes
    repeated = hashes.filter("_h IS NOT NULL").select("_h")
    if repeated.count() <= SENT:
        repeated = F.broadcast(repeated)
    rows = df.select(*columns, F.xxhash64(*columns).alias("_h")).join(repeated, "_h", "left_semi")
    return _counted(rows, columns).filter("n > 1")


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def duplicate_rows(df: DataFrame, columns: Sequence[str], dealt: bool = False) -> DataFrame:
    """Number and share of rows that repeat an earlier one in all ``columns``."""
    if dealt:
        return duplicate_keys(df, columns)
    hashes = hash_groups(df, columns)
    excess = duplicate_groups(df, columns, hashes).agg(
        F.lit(0).cast("bigint").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_excess")
    )
    rows = hashes.agg(F.sum("n").alias("n_rows"), F.lit(0).cast("bigint").alias("n_excess"))
    return _excess(rows.unionByName(excess).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_excess").alias("n_excess")))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number and share of rows that repeat an earlier row's ``key``."""
    return _excess(
        _counted(df, key)
        .agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_excess"))
    )


def _excess(counts: DataFrame) -> DataFrame:
    n_rows, n_excess = (F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_excess"))
    pct = F.try_divide(n_excess.cast("double"), n_rows.cast("double")) * 100
    return counts.select(n_rows.alias("n_rows"), n_excess.alias("n_excess"), pct.alias("pct"))


def duplicate_row_examples(
    df: DataFrame, columns: Sequence[str], limit: int = EXAMPLES, dealt: bool = False
) -> DataFrame:
    """The first ``limit`` rows, in column order with NULLs last, among fully repeated rows."""
    first = [F.col(c).asc_nulls_last() for c in columns]
    # Members of a group are equal, so the smallest groups hold the wanted rows.
    groups = duplicate_groups(df, columns, dealt=dealt).orderBy(*first).limit(limit)
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(limit)).cast("int")))
    return groups.select(*columns, copies.alias("_copy")).orderBy(*first).limit(limit).drop("_copy")


def duplicate_key_examples(
    df: DataFrame, key: Sequence[str], order: Sequence[str], limit: int = EXAMPLES
) -> DataFrame:
    """The first ``limit`` rows by ``key``, NULLs last, whose key repeats; ties by ``order``."""
    first = [F.col(c).asc_nulls_last() for c in key]
    repeated = _counted(df, key).filter("n > 1").orderBy(*first).limit(limit)
    # At most ``limit`` keys, so they come to the driver: as literals they reach the scans below ``df``.
    kinds = [df.schema[c].dataType for c in key]
    chosen = [
        reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(row[c]).cast(t)) for c, t in zip(key, kinds)])
        for row in repeated.collect()
    ]
    return (
        df.filter(reduce(Column.__or__, chosen, F.lit(False)))
        .orderBy(*first, *[F.col(c).asc_nulls_last() for c in order])
        .limit(limit)
    )
