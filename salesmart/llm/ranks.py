"""Numbering rows within groups without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from salesmart.session import materialise


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0) and ``n``: place and number of rows within their ``group``.

    Rows are sorted by range into partitions and written; a group may span any number of them, and
    the counts of the earlier partitions are added to the place within one. Null sorts first and
    is a group of its own. Equal rows get any of their places.
    """
    keys = [*group, *order]
    placed = (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id())
    )
    placed = materialise(placed, name)
    # One row per partition and group in it: partitions + groups rows, and at most the partitions per group.
    counts = placed.groupBy("_part", *group).agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
    within = Window.partitionBy(*group)
    counts = counts.withColumn(
        "_before", F.sum("_rows").over(within.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")
    ).withColumn("n", F.sum("_rows").over(within))
    counts = counts.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_first", "_before", "n")
    same = placed["_part"] == counts["_p"]
    for i, g in enumerate(group):
        same &= placed[g].eqNullSafe(counts[f"_g{i}"])
    return placed.join(counts, same).select(
        *rows.columns, (F.col("_place") - F.col("_first") + F.col("_before")).alias("idx"), "n"
    )
