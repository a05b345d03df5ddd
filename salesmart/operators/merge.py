"""Upserts as joins: insert-ignore, insert-or-update and deletes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.functions.values import item_total
from salesmart.schemas import Table

# Every join here is on a key that is unique on both sides, so no key can be hot.

def stamp(load_ts: datetime) -> Column:
    return F.lit(load_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    table: Table,
    load_ts: datetime,
    update_columns: Sequence[str] | None = None,
    touch_updated_at: bool = False,
) -> DataFrame:
    """Target after inserting ``batch``, whose rows are unique by the table's key.

    Rows with a known key take the batch's ``update_columns``, NULLs included, and keep the
    rest, the load timestamps too. With no update columns the existing row wins.
    """
    updates = table.update_columns if update_columns is None else tuple(update_columns)
    incoming = with_stamps(with_generated(batch, table), table, load_ts)
    if not updates:
        return insert_ignore(target, incoming, table.key)
    taken = set(updates) | set(table.generated)
    if touch_updated_at:
        taken |= {"updated_at"} & set(table.stamps)
    untouched = target.join(batch.select(table.key), table.key, "left_anti")
    return untouched.unionByName(
        updated_rows(target, incoming, table.key, taken).select(target.columns)
    )


def insert_ignore(
    target: DataFrame, incoming: DataFrame, key: str
) -> DataFrame:
    # The few known keys are found first, so that a small batch never makes the target shuffle.
    known = target.select(key).join(incoming.select(key), key, "left_semi")
    fresh = incoming.join(known, key, "left_anti")
    return target.unionByName(fresh.select(target.columns))


def updated_rows(
    target: DataFrame, incoming: DataFrame, key: str, taken: Iterable[str],
) -> DataFrame:
    """The batch's rows, with the columns outside ``taken`` kept from the target if known."""
    taken = set(taken)
    kept = [c for c in incoming.columns if c != key and c not in taken]
    if not kept:
        return incoming
    known = target.join(incoming.select(key), key, "left_semi").select(
        F.col(key), F.struct(*kept).alias("_old")
    )
    return incoming.join(known, key, "left").select(
        *[
            F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c)
            if c in kept
            else F.col(c)
            for c in incoming.columns
        ]
    )


def with_generated(batch: DataFrame, table: Table) -> DataFrame:
    if "item_total" not in table.generated:
        return batch
    return batch.withColumn("item_total", item_total(F.col("quantity"), F.col("unit_price")))


def with_stamps(batch: DataFrame, table: Table, load_ts: datetime) -> DataFrame:
    return batch.withColumns({name: stamp(load_ts) for name in table.stamps})


def delete_orders(
    orders: DataFrame, items: DataFrame, doomed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Orders and items left after deleting the sale ids in ``doomed``; items go with them."""
    keys = doomed.select("sale_id")
    return (
        orders.join(keys, "sale_id", "left_anti"),
        items.join(keys, "sale_id", "left_anti"),
    )


def delete_restricted(doomed: DataFrame, key: str, children: DataFrame) -> DataFrame:
    """Keys whose deletion is refused because child rows refer to them, with their number."""
    references = (
        children.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_references"))
    )
    return references.join(doomed.select(key), key, "left_semi")
