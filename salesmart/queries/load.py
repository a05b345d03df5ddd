"""Deduplication, dimension derivation, upserts, deletes, views and the full load."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesmart.operators.merge import (
    delete_orders, delete_restricted, stamp, upsert, with_generated, with_stamps,
)
from salesmart.plans.clean import clean_rows
from salesmart.plans.daily_load import daily_load
from salesmart.plans.entities import calendar_rows, conform, entity_rows
from salesmart.plans.views import orders_with_stored_total, orders_with_total, sales_lines
from salesmart.plans.warehouse import COMPRESSION, Warehouse
from salesmart.queries import query
from salesmart.queries.sql import (
    BATCHES, CHANGED, DICTIONARY_COLUMNS, FIRST_TS, FLAG, FLAT, PERCENT, SECOND_TS, TOTAL, UPSERTED_DATES, calendar, clean, entity, upserted, with_,
)
from salesmart.schemas import (
    CUSTOMERS, DIM_DATES, ORDER_ITEMS, ORDERS, PRODUCTS, SCHEMA_COMMENT, TABLES,
)
from salesmart.session import materialise, scratch_path, stored
from salesmart.sources.testtables import (
    FLAT_ORDER, batch_rows, by_key, changed_batch, flat_sales, line_parts, table, target_rows,
)

FIRST = datetime(2025, 6, 16, 6)
SECOND = datetime(2025, 6, 17, 6)


def _loaded(rows: DataFrame, tab, load_ts: datetime) -> DataFrame:
    """The table after loading ``rows`` into nothing."""
    entity = conform(entity_rows(clean_rows(rows), tab, FLAT_ORDER), tab)
    return with_stamps(with_generated(entity, tab), tab, load_ts)


def _two_loads(spark, sf_dir, tab, reverse: bool = False) -> DataFrame:
    flat = flat_sales(spark, sf_dir, by_key(tab))
    first, second = target_rows(flat), changed_batch(flat)
    if reverse:
        first, second = second, first
    batch = conform(entity_rows(clean_rows(second), tab, FLAT_ORDER), tab)
    # Stored, as a load stages its batch: a merge looks several times at both sides.
    return upsert(
        materialise(_loaded(first, tab, FIRST), "target"), materialise(batch, "batch"), tab, SECOND
    )


# --- deduplication and dimensions -------------------------------------------------------------


@query("dedup_customers", with_(FLAT, entity("customers", "flat")))
def dedup_customers(spark, sf_dir):
    return entity_rows(flat_sales(spark, sf_dir), CUSTOMERS, FLAT_ORDER)


@query("dedup_products", with_(FLAT, entity("products", "flat")))
def dedup_products(spark, sf_dir):
    return entity_rows(flat_sales(spark, sf_dir, by_key(PRODUCTS)), PRODUCTS, FLAT_ORDER)


@query("dedup_orders", with_(FLAT + ", " + clean("flat"), entity("orders", "cleaned")))
def dedup_orders(spark, sf_dir):
    return entity_rows(clean_rows(flat_sales(spark, sf_dir)), ORDERS, FLAT_ORDER)


@query("dim_dates", with_(FLAT, calendar("flat")))
def dim_dates(spark, sf_dir):
    return calendar_rows(flat_sales(spark, sf_dir))


# --- upserts ------------------------------------------------------------------------------------


# The first load counts Sundays only as weekend; as existing dates win, its flags stay.
@query("upsert_dim_dates", with_(BATCHES, f"""
SELECT *, {FIRST_TS} AS created_at FROM ({calendar('t', 'isodow(d) = 7')})
UNION ALL
SELECT *, {SECOND_TS} AS created_at FROM ({calendar('b')})
WHERE date_id NOT IN (SELECT date_id FROM t)"""))
def upsert_dim_dates(spark, sf_dir):
    flat = flat_sales(spark, sf_dir)
    existing = with_stamps(calendar_rows(target_rows(flat), "sunday_only"), DIM_DATES, FIRST)
    return upsert(existing, calendar_rows(batch_rows(flat)), DIM_DATES, SECOND)


@query("upsert_customers", with_(CHANGED, upserted("customers")))
def upsert_customers(spark, sf_dir):
    return _two_loads(spark, sf_dir, CUSTOMERS)


@query("upsert_products", with_(CHANGED, upserted("products")))
def upsert_products(spark, sf_dir):
    return _two_loads(spark, sf_dir, PRODUCTS)


@query("upsert_orders", with_(CHANGED, upserted("orders")))
def upsert_orders(spark, sf_dir):
    return _two_loads(spark, sf_dir, ORDERS)


@query("upsert_order_items", with_(CHANGED, upserted("order_items")))
def upsert_order_items(spark, sf_dir):
    return _two_loads(spark, sf_dir, ORDER_ITEMS)


@query("upsert_backfill_order", with_(CHANGED, upserted("customers", "b", "t")))
def upsert_backfill_order(spark, sf_dir):
    """The older batch loaded last: it still overwrites the attributes."""
    return _two_loads(spark, sf_dir, CUSTOMERS, reverse=True)


# Only prices may change; known products keep all else.
@query("upsert_generic", with_(CHANGED, f"""
SELECT n.product_id, coalesce(o.product_name, n.product_name) AS product_name,
       coalesce(o.category, n.category) AS category, coalesce(o.brand, n.brand) AS brand,
       coalesce(o.color, n.color) AS color, coalesce(o.size, n.size) AS size,
       n.catalog_price, n.cost_price,
       CASE WHEN o.product_id IS NULL THEN {SECOND_TS} ELSE {FIRST_TS} END AS created_at,
       {SECOND_TS} AS updated_at
FROM ({entity('products', 'b')}) n LEFT JOIN ({entity('products', 't')}) o USING (product_id)
UNION ALL
SELECT *, {FIRST_TS} AS created_at, {FIRST_TS} AS updated_at FROM ({entity('products', 't')})
WHERE product_id NOT IN (SELECT product_id FROM b)"""))
def upsert_generic(spark, sf_dir):
    flat = flat_sales(spark, sf_dir, by_key(PRODUCTS))
    batch = conform(entity_rows(clean_rows(changed_batch(flat)), PRODUCTS, FLAT_ORDER), PRODUCTS)
    return upsert(
        materialise(_loaded(target_rows(flat), PRODUCTS, FIRST), "target"), materialise(batch, "batch"),
        PRODUCTS, SECOND,
        update_columns=["catalog_price", "cost_price"], touch_updated_at=True,
    )


# What the dictionary says of every column.
_DICTIONARY = """(VALUES
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 0, 'date_id', 'int', 'calendar day as an integer yyyymmdd'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 1, 'full_date', 'date', 'calendar day'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 2, 'year', 'smallint', 'calendar year'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 3, 'month', 'smallint', 'month of the year, 1 to 12'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 4, 'day', 'smallint', 'day of the month'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 5, 'day_of_week', 'string', 'English weekday name'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 6, 'week_number', 'smallint', 'ISO week number'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 7, 'quarter', 'smallint', 'quarter of the year, 1 to 4'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 8, 'is_weekend', 'boolean', 'Saturday or Sunday'),
  ('dim_dates', 'Calendar dimension, one row per day seen in the sales', 9, 'is_holiday', 'boolean', 'public holiday, false until enriched'),
  ('customers', 'One row per customer', 0, 'customer_id', 'bigint', 'customer identifier'),
  ('customers', 'One row per customer', 1, 'first_name', 'string', 'first name'),
  ('customers', 'One row per customer', 2, 'last_name', 'string', 'last name'),
  ('customers', 'One row per customer', 3, 'email', 'string', 'e-mail address, unique over customers'),
  ('customers', 'One row per customer', 4, 'gender', 'string', 'declared gender'),
  ('customers', 'One row per customer', 5, 'age_range', 'string', 'age bracket'),
  ('customers', 'One row per customer', 6, 'signup_date', 'date', 'day the customer signed up'),
  ('customers', 'One row per customer', 7, 'country', 'string', 'country of the customer'),
  ('products', 'One row per catalogue product', 0, 'product_id', 'int', 'product identifier'),
  ('products', 'One row per catalogue product', 1, 'product_name', 'string', 'product name'),
  ('products', 'One row per catalogue product', 2, 'category', 'string', 'product category'),
  ('products', 'One row per catalogue product', 3, 'brand', 'string', 'product brand'),
  ('products', 'One row per catalogue product', 4, 'color', 'string', 'product colour'),
  ('products', 'One row per catalogue product', 5, 'size', 'string', 'product size'),
  ('products', 'One row per catalogue product', 6, 'catalog_price', 'decimal(12,2)', 'list price'),
  ('products', 'One row per catalogue product', 7, 'cost_price', 'decimal(12,2)', 'cost price, at most the list price'),
  ('orders', 'One row per order', 0, 'sale_id', 'bigint', 'order identifier'),
  ('orders', 'One row per order', 1, 'sale_date', 'date', 'day of the order'),
  ('orders', 'One row per order', 2, 'date_id', 'int', 'calendar day as an integer yyyymmdd'),
  ('orders', 'One row per order', 3, 'customer_id', 'bigint', 'customer identifier'),
  ('orders', 'One row per order', 4, 'channel', 'string', 'sales channel'),
  ('orders', 'One row per order', 5, 'channel_campaigns', 'string', 'campaign of the channel'),
  ('order_items', 'One row per order line, the fact table', 0, 'item_id', 'bigint', 'order line identifier'),
  ('order_items', 'One row per order line, the fact table', 1, 'sale_id', 'bigint', 'order identifier'),
  ('order_items', 'One row per order line, the fact table', 2, 'product_id', 'int', 'product identifier'),
  ('order_items', 'One row per order line, the fact table', 3, 'quantity', 'int', 'units sold'),
  ('order_items', 'One row per order line, the fact table', 4, 'original_price', 'decimal(12,2)', 'unit price before discount'),
  ('order_items', 'One row per order line, the fact table', 5, 'unit_price', 'decimal(12,2)', 'unit price paid'),
  ('order_items', 'One row per order line, the fact table', 6, 'discount_applied', 'decimal(12,2)', 'discount amount per unit'),
  ('order_items', 'One row per order line, the fact table', 7, 'discount_percent', 'decimal(5,2)', 'discount in percent, 0 to 100'),
  ('order_items', 'One row per order line, the fact table', 8, 'discounted', 'boolean', 'whether a discount was applied')
) d(table_name, table_comment, position, column_name, data_type, column_comment)"""


@query("data_dictionary", with_(FLAT + ", " + clean("flat") + ", fill AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, unnest(['{"', '".join(columns)}']) AS column_name, "
    f"unnest([{', '.join(f'count({c})' for c in columns)}]) AS n_non_null "
    f"FROM ({calendar('cleaned') if name == 'dim_dates' else entity(name, 'cleaned')})"
    for name, columns in DICTIONARY_COLUMNS.items()) + ")", f"""
SELECT 'Sales mart: normalised sales data of the shop' AS schema_comment, table_name, table_comment,
       CAST(position AS INTEGER) AS position, column_name, data_type, column_comment, n_non_null
FROM {_DICTIONARY} JOIN fill USING (table_name, column_name)"""))
def data_dictionary(spark, sf_dir):
    """Every loaded column with its comment and fill."""
    parts = []
    for name, tab in TABLES.items():
        rows = clean_rows(flat_sales(spark, sf_dir, by_key(tab)))
        entity = conform(entity_rows(rows, tab, FLAT_ORDER), tab)
        fields = tab.schema.fields[: len(tab.columns)]
        cells = [
            F.struct(
                F.lit(SCHEMA_COMMENT).alias("schema_comment"),
                F.lit(name).alias("table_name"),
                F.lit(tab.comment).alias("table_comment"),
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.metadata["comment"]).alias("column_comment"),
                F.count(f.name).alias("n_non_null"),
            )
            for i, f in enumerate(fields)
        ]
        parts.append(entity.agg(F.array(*cells).alias("r")).select(F.inline("r")))
    return reduce(DataFrame.unionByName, parts)


# --- the full load ------------------------------------------------------------------------------


def _days(rows: DataFrame) -> list:
    """The days present in ``rows``: one value per calendar day."""
    return [r.sale_date for r in rows.select("sale_date").distinct().collect()]


@contextmanager
def _load_both(spark, sf_dir):
    """The warehouse after both loads, the sales file that they read, and their results.

    The file is there inside only.
    """
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.bootstrap(by="year")
    with stored(flat_sales(spark, sf_dir), "sales-file", COMPRESSION) as flat:
        results = []
        for rows, load_ts in ((target_rows(flat), FIRST), (changed_batch(flat), SECOND)):
            results.append(daily_load(warehouse, rows, _days(rows), load_ts, FLAT_ORDER))
        yield warehouse, flat, results


_MERGED = f"""{CHANGED},
dim_dates AS ({UPSERTED_DATES}),
customers AS ({upserted('customers')}),
products AS ({upserted('products')}),
sales AS ({upserted('orders')}),
order_items AS ({upserted('order_items')})"""


@query("full_load", with_(_MERGED, """
SELECT * FROM (SELECT * EXCLUDE (created_at) FROM order_items)
JOIN (SELECT * EXCLUDE (created_at, updated_at) FROM sales) USING (sale_id)
JOIN (SELECT * EXCLUDE (created_at) FROM dim_dates) USING (date_id)
JOIN (SELECT * EXCLUDE (created_at, updated_at) FROM customers) USING (customer_id)
JOIN (SELECT * EXCLUDE (created_at, updated_at) FROM products) USING (product_id)"""))
def full_load(spark, sf_dir):
    """Two overlapping batches loaded and published, read back as one row per order line."""
    with _load_both(spark, sf_dir) as (warehouse, _, _):
        n_lines = sum(e.n_rows for e in warehouse.manifest().of("order_items"))
    return sales_lines(warehouse.tables(), line_parts(spark, n_lines))


@query("maintained_totals", with_(_MERGED, """
SELECT sale_id, sale_date, customer_id, channel,
       CAST(coalesce(sum(item_total), 0) AS DECIMAL(18,2)) AS total_amount, count(item_id) AS n_items
FROM sales LEFT JOIN order_items USING (sale_id) GROUP BY sale_id, sale_date, customer_id, channel"""))
def maintained_totals(spark, sf_dir):
    """Order totals kept up to date by two overlapping loads, without reading the items."""
    with _load_both(spark, sf_dir) as (warehouse, _, _):
        pass
    totals = warehouse.order_totals()
    orders = warehouse.read("orders").select("sale_id", "sale_date", "customer_id", "channel")
    n_items = totals.select("sale_id", "n_items")
    return orders_with_stored_total(orders, totals).join(n_items, "sale_id", "left").withColumn(
        "n_items", F.coalesce("n_items", F.lit(0).cast("long"))
    )


_CONTROL = {
    "dim_dates": "date_id", "customers": "customer_id", "products": "product_id",
    "orders": "sale_id", "order_items": "item_id",
}
# What the second batch corrects, as a number.
_VALUE = {
    "dim_dates": "week_number", "customers": "length(country)",
    "products": "CAST(catalog_price * 100 AS BIGINT)", "orders": "date_id + length(channel)",
    "order_items": "CAST(item_total * 100 AS BIGINT)",
}


@query("idempotent_reload", with_(_MERGED, "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, CAST(sum({key}) AS BIGINT) AS key_sum, "
    f"CAST(sum({_VALUE[name]}) AS BIGINT) AS value_sum, "
    f"count(*) FILTER (WHERE created_at = {FIRST_TS}) AS n_first_load, CAST(0 AS BIGINT) AS n_changed "
    f"FROM {'sales' if name == 'orders' else name}"
    for name, key in _CONTROL.items())))
def idempotent_reload(spark, sf_dir):
    """The second batch loaded once more: per table its control sums, and the rows that differ
    from the state before."""
    with _load_both(spark, sf_dir) as (warehouse, flat, _):
        former = warehouse.manifest()
        again = changed_batch(flat)
        daily_load(warehouse, again, _days(again), SECOND, FLAT_ORDER)
    latter = warehouse.manifest()
    parts = []
    for name, key in _CONTROL.items():
        # Both states lie in the same buckets: rows meet by key without a shuffle.
        old, new = (
            warehouse.merge_side(name, state.of(name), state.buckets).select(TABLES[name].schema.fieldNames())
            for state in (former, latter)
        )
        rest = [c for c in old.columns if c != key]
        before = old.select(F.col(key).alias("_key"), F.struct(*rest).alias("_old"))
        after = new.select(F.col(key), F.struct(*rest).alias("_new"))
        both = after.join(before.hint("merge"), F.col(key) == F.col("_key"), "full")
        # Of a row that changed, the old and the new one differ.
        sides = F.col("_old").isNotNull().cast("int") + F.col("_new").isNotNull().cast("int")
        changed = F.when(F.col("_old").eqNullSafe(F.col("_new")), 0).otherwise(sides)
        present = both.select(key, "_new.*", F.col("_new").isNotNull().alias("_there"), changed.alias("_changed"))
        parts.append(
            present.agg(
                F.count_if("_there").alias("n_rows"),
                F.sum(F.col(key).cast("bigint")).alias("key_sum"),
                F.sum(F.expr(_VALUE[name]).cast("bigint")).alias("value_sum"),
                F.count_if(F.col("_there") & (F.col("created_at") == stamp(FIRST))).alias("n_first_load"),
                F.sum("_changed").alias("n_changed"),
            ).withColumn("table_name", F.lit(name))
        )
    return reduce(DataFrame.unionByName, parts).select(
        "table_name", "n_rows", "key_sum", "value_sum", "n_first_load", "n_changed"
    )


@query("load_metrics", with_(CHANGED, """
SELECT 1 AS load, 'read' AS step, count(*) AS n_rows FROM t
UNION ALL SELECT 2, 'read', count(*) FROM b
UNION ALL SELECT 1, 'filtered', count(*) FROM t UNION ALL SELECT 2, 'filtered', count(*) FROM b
UNION ALL SELECT i, s, 0 FROM (VALUES (1), (2)) v(i), (VALUES ('bad_dates'), ('bad_records')) w(s)
""" + "\n".join(
    f"UNION ALL SELECT {i}, 'bad_percents', count(*) FROM flat WHERE {when} AND ({PERCENT}) IS NULL "
    f"UNION ALL SELECT {i}, 'bad_flags', count(*) FROM flat WHERE {when} AND ({FLAG}) IS NULL "
    f"UNION ALL SELECT {i}, 'warnings', count(*) FROM {src} "
    "WHERE discounted <> (discount_applied > 0 OR discount_percent > 0)"
    for i, src, when in ((1, "t", "sale_date < DATE '1998-07-01'"),
                         (2, "b", "sale_date >= DATE '1998-01-01'"))) + "\n" + "\n".join(
    f"UNION ALL SELECT {i}, 'upserted_{name}', count(DISTINCT {key}) FROM {src}"
    for i, src in ((1, "t"), (2, "b")) for name, key in _CONTROL.items())))
def load_metrics(spark, sf_dir):
    with _load_both(spark, sf_dir) as (_, _, results):
        pass
    rows = [(i, step, n) for i, r in enumerate(results, 1) for step, n in r.metrics.items()]
    return spark.createDataFrame(rows, "load int, step string, n_rows long")


# --- views and deletes --------------------------------------------------------------------------


@query("orders_with_total", with_(FLAT + ", " + clean("flat"), f"""
SELECT o_orderkey AS sale_id, CAST(o_orderdate AS DATE) AS sale_date, o_custkey AS customer_id,
       o_orderpriority AS channel, CAST(coalesce(sum(item_total), 0) AS DECIMAL(18,2)) AS total_amount
FROM orders LEFT JOIN (SELECT *, {TOTAL} FROM ({entity('order_items', 'cleaned')})) ON o_orderkey = sale_id
GROUP BY ALL"""))
def order_totals(spark, sf_dir):
    """All orders, also those without a line."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("channel"),
    )
    return orders_with_total(orders, _loaded(flat_sales(spark, sf_dir), ORDER_ITEMS, FIRST))


@query("delete_orders_cascade", with_(FLAT + ", " + clean("flat"), f"""
SELECT item_id, sale_id, sale_date, date_id, customer_id, channel
FROM (SELECT sale_id, sale_date, date_id, customer_id, channel FROM ({entity('orders', 'cleaned')})
      WHERE sale_date < DATE '1998-01-01' OR sale_date >= DATE '1998-07-01')
JOIN (SELECT item_id, sale_id FROM ({entity('order_items', 'cleaned')})) USING (sale_id)"""))
def delete_orders_cascade(spark, sf_dir):
    """Orders of half a year deleted; what is left of orders and items, joined."""
    flat = flat_sales(spark, sf_dir)
    orders, items = _loaded(flat, ORDERS, FIRST), _loaded(flat, ORDER_ITEMS, FIRST)
    doomed = batch_rows(target_rows(orders))
    left_orders, left_items = delete_orders(orders, items, doomed)
    return left_items.select("item_id", "sale_id").join(
        left_orders.select("sale_id", "sale_date", "date_id", "customer_id", "channel"), "sale_id"
    )


@query("delete_restrict_violations", with_(FLAT + ", " + clean("flat"), f"""
SELECT 'customers' AS table_name, CAST(customer_id AS BIGINT) AS key, count(*) AS n_references
FROM ({entity('orders', 'cleaned')})
WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
GROUP BY customer_id
UNION ALL
SELECT 'products', CAST(product_id AS BIGINT), count(*) FROM ({entity('order_items', 'cleaned')})
WHERE product_id IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
GROUP BY product_id"""))
def delete_restrict_violations(spark, sf_dir):
    """Customers of a segment and products of a type to delete: the ones still referred to."""
    flat = flat_sales(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'").select(
        F.col("c_custkey").alias("customer_id")
    )
    products = table(spark, sf_dir, "part").filter("p_type = 'ECONOMY'").select(
        F.col("p_partkey").cast("int").alias("product_id")
    )
    refused = [
        ("customers", "customer_id", delete_restricted(customers, "customer_id", _loaded(flat, ORDERS, FIRST))),
        ("products", "product_id", delete_restricted(products, "product_id", _loaded(flat, ORDER_ITEMS, FIRST))),
    ]
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"), "n_references")
            for name, key, df in refused
        ],
    )
