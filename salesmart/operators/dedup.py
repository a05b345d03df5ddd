"""One row per key, chosen by file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` of the first row of every ``key`` in file order; NULL keys are one key.

    A key may be several columns.
    """
    return _pick(df, key, columns, F.min, order)


def keep_last(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``columns`` of the last row of every ``key`` in file order."""
    return _pick(df, key, columns, F.max, order)


def _pick(df: DataFrame, key: str | Sequence[str], columns: Sequence[str], choose, order: Sequence[str]) -> DataFrame:
    # An aggregate, not a window: every map task reduces its rows to one per key before the
    # shuffle, so a key that holds a third of the table costs one row per task. A struct is no
    # buffer for hash aggregation, so the task sorts its rows by the key for that.
    keys = [key] if isinstance(key, str) else list(key)
    # Rows are compared by the order first. Every column is sent once, and a key, the same in all rows
    # of its group, not again.
    row: list[str] = [c for c in dict.fromkeys([*order, *columns]) if c not in keys]
    if not row:
        return df.select(*columns).distinct()
    chosen: Column = choose(F.struct(*row))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in columns]
    )
