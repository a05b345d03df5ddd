"""The five tables' rows contained in cleaned sales rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from salesmart.functions.dates import calendar_columns
from salesmart.functions.values import to_type
from salesmart.operators.dedup import keep_first, keep_last
from salesmart.schemas import CUSTOMERS, DIM_DATES, ORDER_ITEMS, ORDERS, TABLES, Table


def calendar_rows(rows: DataFrame, weekend_rule: str = "sat_sun") -> DataFrame:
    """One date-dimension row per distinct sale date."""
    days = rows.select("sale_date").filter(F.col("sale_date").isNotNull()).distinct()
    return days.select(*calendar_columns(F.col("sale_date"), weekend_rule))


def project(rows: DataFrame, table: Table) -> DataFrame:
    return rows.select(*table.column_names)


def entity_rows(
    rows: DataFrame, table: Table, order: Sequence[str], weekend_rule: str = "sat_sun",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Rows to upsert into ``table``: unique by its key.

    Customers, products and orders keep the first row of a key in file order, order items the
    last, as if applied one after the other. ``extra`` columns of the chosen row come along.
    """
    if table is DIM_DATES:
        return calendar_rows(rows, weekend_rule)
    choose = keep_last if table is ORDER_ITEMS else keep_first
    return choose(rows, table.key, order, [*table.column_names, *extra])


# Tables whose rows are chosen among the first ones of every order, customer and day.
HEADED = (DIM_DATES, CUSTOMERS, ORDERS)


def head_rows(rows: DataFrame, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first row of every order, customer and day with ``columns``; ``_leads`` its order if first of all.

    Rows that lie together by order are not shuffled for it, and an order has few of them.
    """
    keys = ["sale_id", "customer_id", "sale_date"]
    heads = keep_first(rows, keys, order, list(dict.fromkeys([*keys, *order, *columns])))
    return heads.withColumn("_leads", F.row_number().over(Window.partitionBy("sale_id").orderBy(*order)) == 1)


def headed_rows(
    heads: DataFrame, table: Table, order: Sequence[str], columns: Sequence[str], weekend_rule: str = "sat_sun"
) -> DataFrame:
    """``entity_rows`` of one of the ``HEADED`` tables, with ``columns``, from ``head_rows``.

    The same as from all rows: the first row of a customer is the first one of its order and day there, and
    every day is present.
    """
    if table is DIM_DATES:
        return calendar_rows(heads, weekend_rule)
    if table is ORDERS:
        return heads.filter("_leads").select(*columns)
    return keep_first(heads, table.key, order, columns)


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """Columns coerced to the table's types; other columns are left as they are."""
    have = dict(rows.dtypes)
    return rows.select(
        *[
            to_type(c, table.columns[c])
            if c in table.columns and have[c] != table.columns[c].simpleString()
            else F.col(c)
            for c in rows.columns
        ]
    )


def all_entities(rows: DataFrame, order: Sequence[str], weekend_rule: str = "sat_sun") -> dict:
    return {
        name: conform(entity_rows(rows, table, order, weekend_rule), table)
        for name, table in TABLES.items()
    }
