"""Constraint rules over the dirty batch and over the two overlapping batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesmart.operators.quality import (
    check_rules,
    coercion_rules,
    duplicate_violations,
    key_violations,
    not_null_rules,
    reference_violations,
    row_violations,
    varchar_rules,
    warning_rules,
)
from salesmart.plans.clean import clean_rows, sale_day
from salesmart.plans.entities import HEADED, all_entities, conform, entity_rows, head_rows, headed_rows
from salesmart.queries import query
from salesmart.queries.load import FIRST, SECOND
from salesmart.queries.sql import (
    BATCHES, COLUMNS, DAY, DIRTY, FLAT, KEY, ORDER_DIRTY, PERCENT, calendar, clean, entity,
    with_,
)
from salesmart.operators.merge import upsert, with_stamps
from salesmart.schemas import CUSTOMERS, DIM_DATES, ORDER_ITEMS, ORDERS, PRODUCTS, TABLES
from salesmart.session import materialise
from salesmart.sources.testtables import (
    DIRTY_ORDER, FLAT_ORDER, batch_rows, by_key, dirty_sales, flat_sales, target_rows,
)

# --- the dirty file as one batch ----------------------------------------------------------------


def _dirty_rows(spark, sf_dir, tab) -> DataFrame:
    df = dirty_sales(spark, sf_dir, by_key(tab))
    return clean_rows(df.withColumn("sale_date", sale_day(df)))


def _dirty_batch(spark, sf_dir, tab) -> DataFrame:
    """Rows of ``tab`` that are checked: the chosen row per key, for items every row."""
    rows = _dirty_rows(spark, sf_dir, tab)
    if tab is ORDER_ITEMS:
        return rows.select(*tab.column_names)
    return entity_rows(rows, tab, DIRTY_ORDER)


def _dirty_batches(spark, sf_dir, columns) -> dict[str, DataFrame]:
    """``_dirty_batch`` of the tables that ``columns`` has columns of, with these.

    Dates, customers and orders come from one pass over the flat rows, which stores the few they are
    chosen from.
    """
    headed = [tab for tab in HEADED if tab.name in columns]
    batches = {name: _dirty_batch(spark, sf_dir, TABLES[name]) for name in columns if TABLES[name] not in headed}
    if headed:
        wanted = [c for tab in headed if tab is not DIM_DATES for c in columns[tab.name]]
        heads = materialise(head_rows(_dirty_rows(spark, sf_dir, ORDERS), DIRTY_ORDER, wanted), "heads")
        batches |= {tab.name: headed_rows(heads, tab, DIRTY_ORDER, columns[tab.name]) for tab in headed}
    return {name: batches[name] for name in columns}


def _check(tab, rules):
    def run(spark, sf_dir):
        batch = _dirty_batch(spark, sf_dir, tab)
        return row_violations(batch, tab, rules(batch, tab))

    return run


def _named(rules, *names):
    return lambda df, tab: [r for r in rules(df, tab) if r.name in names]


_DIRTY_ROWS = DIRTY + f""", dated AS (SELECT * REPLACE ({DAY} AS sale_date) FROM dirty),
{clean('dated')},
customers AS ({entity('customers', 'cleaned', ORDER_DIRTY)}),
products AS ({entity('products', 'cleaned', ORDER_DIRTY)}),
sales AS ({entity('orders', 'cleaned', ORDER_DIRTY)}),
items AS (SELECT {COLUMNS['order_items']} FROM cleaned),
dates AS ({calendar('cleaned')})"""
_FROM = {"customers": "customers", "products": "products", "orders": "sales",
         "order_items": "items", "dim_dates": "dates"}
_KEY = {**KEY, "dim_dates": "date_id"}


def _violations(checks: list[tuple[str, str, str, str]], severity: str = "error", ctes: str = _DIRTY_ROWS) -> str:
    """SQL of violation rows from (table, rule, condition that is false, shown value)."""
    return with_(ctes, "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{severity}' AS severity, "
        f"CAST({_KEY[t]} AS VARCHAR) AS pk, CAST({value} AS VARCHAR) AS value "
        f"FROM {_FROM[t]} WHERE NOT ({holds})"
        for t, rule, holds, value in checks
    ))


_CATALOG = "TRY_CAST(catalog_price AS DECIMAL(12,2))"
_PCT = "CAST(discount_percent AS DECIMAL(5,2))"

query("chk_gender", _violations([("customers", "check:gender",
      "gender IN ('M', 'F', 'Other', 'Unknown', NULL)", "gender")]))(
    _check(CUSTOMERS, check_rules))

query("chk_gender_strict", _violations([("customers", "warn:gender",
      "gender IN ('M', 'F', 'Other', 'Unknown')", "gender")], "warning"))(
    _check(CUSTOMERS, warning_rules))

query("chk_product_prices", _violations([
    ("products", "check:catalog_price", f"{_CATALOG} >= 0", "catalog_price"),
    ("products", "check:cost_price", f"cost_price >= 0 AND cost_price <= {_CATALOG}", "cost_price"),
]))(_check(PRODUCTS, check_rules))

query("chk_item_amounts", _violations([
    ("order_items", "check:quantity", "quantity > 0", "quantity"),
    ("order_items", "check:original_price", "original_price >= 0", "original_price"),
    ("order_items", "check:unit_price", "unit_price >= 0", "unit_price"),
]))(_check(ORDER_ITEMS, _named(check_rules, "check:quantity", "check:original_price", "check:unit_price")))

query("chk_discount_range", _violations([
    ("order_items", "check:discount_applied", "discount_applied >= 0", "discount_applied"),
    ("order_items", "check:discount_percent", f"{_PCT} BETWEEN 0 AND 100", _PCT),
]))(_check(ORDER_ITEMS, _named(check_rules, "check:discount_applied", "check:discount_percent")))

query("chk_item_total", _violations([
    ("order_items", "check:item_total", "quantity * unit_price >= 0",
     "CAST(quantity * unit_price AS DECIMAL(12,2))"),
]))(_check(ORDER_ITEMS, _named(check_rules, "check:item_total")))

query("chk_discount_consistency", _violations([
    ("order_items", "check:discount_consistency",
     f"(discount_applied = 0 AND {_PCT} = 0) OR (discount_applied > 0 OR {_PCT} > 0)",
     f"concat(discount_applied, '/', {_PCT})"),
]))(_check(ORDER_ITEMS, _named(check_rules, "check:discount_consistency")))

query("warn_discount_flag", _violations([
    ("order_items", "warn:discount_flag", f"discounted = (discount_applied > 0 OR {_PCT} > 0)", "discounted"),
], "warning"))(_check(ORDER_ITEMS, warning_rules))


def _over_tables(rules, columns=None):
    """``rules`` over all tables; ``columns`` gives those of a table that its rules look at, if known."""

    def run(spark, sf_dir):
        if columns is None:
            batches = {name: _dirty_batch(spark, sf_dir, tab) for name, tab in TABLES.items()}
        else:
            wanted = {name: list(dict.fromkeys([tab.key, *columns(tab)])) for name, tab in TABLES.items() if columns(tab)}
            batches = _dirty_batches(spark, sf_dir, wanted)
        found = [(df, TABLES[name], rules(df, TABLES[name])) for name, df in batches.items()]
        return reduce(
            DataFrame.unionByName,
            [row_violations(df, tab, chosen) for df, tab, chosen in found if chosen],
        )

    return run


query("chk_not_null", _violations([
    (name, f"not_null:{c}", f"{c} IS NOT NULL", "NULL")
    for name, columns in {
        "dim_dates": ["date_id", "full_date", "year", "month", "day"],
        "customers": ["customer_id"],
        "products": ["product_id", "product_name", "catalog_price"],
        "orders": ["sale_id", "sale_date", "date_id", "customer_id"],
        "order_items": ["item_id", "sale_id", "product_id", "quantity", "original_price", "unit_price"],
    }.items() for c in columns
]))(_over_tables(not_null_rules, lambda tab: (tab.key, *tab.not_null)))

query("chk_varchar_len", _violations([
    (name, f"varchar:{c}", f"length({c}) <= {n}", c)
    for name, widths in {
        "dim_dates": {"day_of_week": 10},
        "customers": {"first_name": 100, "last_name": 100, "email": 255, "gender": 20,
                      "age_range": 20, "country": 100},
        "products": {"product_name": 255, "category": 100, "brand": 100, "color": 50, "size": 50},
        "orders": {"channel": 50, "channel_campaigns": 100},
    }.items() for c, n in widths.items()
]))(_over_tables(varchar_rules, lambda tab: tuple(tab.varchar)))

query("chk_decimal_overflow", _violations([
    (name, f"coercion:{c}", f"{c} IS NULL OR TRY_CAST({c} AS {dtype}) IS NOT NULL", c)
    for name, c, dtype in [
        ("products", "catalog_price", "DECIMAL(12,2)"), ("products", "cost_price", "DECIMAL(12,2)"),
        ("order_items", "original_price", "DECIMAL(12,2)"), ("order_items", "unit_price", "DECIMAL(12,2)"),
        ("order_items", "discount_applied", "DECIMAL(12,2)"),
        ("order_items", "discount_percent", "DECIMAL(5,2)"),
    ]
]))(_over_tables(coercion_rules))


@query("coerce_decimals", with_(DIRTY, f"""
SELECT item_id, product_id, copy, {_CATALOG} AS catalog_price,
       TRY_CAST(cost_price AS DECIMAL(12,2)) AS cost_price,
       TRY_CAST(original_price AS DECIMAL(12,2)) AS original_price,
       TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
       TRY_CAST(discount_applied AS DECIMAL(12,2)) AS discount_applied,
       CAST(coalesce({PERCENT}, 0.0) AS DECIMAL(5,2)) AS discount_percent
FROM dirty"""))
def coerce_decimals(spark, sf_dir):
    df = dirty_sales(spark, sf_dir)
    rows = clean_rows(df.withColumn("sale_date", sale_day(df)))
    amounts = rows.select(
        "item_id", "product_id", "copy", "catalog_price", "cost_price", "original_price",
        "unit_price", "discount_applied", "discount_percent",
    )
    return conform(conform(amounts, PRODUCTS), ORDER_ITEMS)


# --- keys, uniqueness and references --------------------------------------------------------------


# The raw item rows repeat keys; the chosen rows of the other tables have only NULL keys left.
@query("chk_pk", with_(_DIRTY_ROWS, "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'not_null:{_KEY[t]}' AS rule, 'error' AS severity, "
    f"CAST(NULL AS VARCHAR) AS pk, CAST(NULL AS VARCHAR) AS value FROM {src} WHERE {_KEY[t]} IS NULL "
    f"UNION ALL SELECT '{t}', 'unique:{_KEY[t]}', 'error', CAST({_KEY[t]} AS VARCHAR), "
    f"CAST(count(*) AS VARCHAR) FROM {src} WHERE {_KEY[t]} IS NOT NULL "
    f"GROUP BY {_KEY[t]} HAVING count(*) > 1"
    for t, src in _FROM.items())))
def chk_pk(spark, sf_dir):
    return reduce(
        DataFrame.unionByName,
        [key_violations(_dirty_batch(spark, sf_dir, tab), tab) for tab in TABLES.values()],
    )


_UNIQUE = "'error' AS severity, CAST({c} AS VARCHAR) AS pk, CAST(count(*) AS VARCHAR) AS value"


@query("chk_email_unique", with_(_DIRTY_ROWS, f"""
SELECT 'customers' AS table_name, 'unique:email' AS rule, {_UNIQUE.format(c='email')}
FROM (SELECT email FROM customers
      UNION ALL SELECT email FROM ({entity('customers', 'flat')})
      WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE customer_id IS NOT NULL))
WHERE email IN (SELECT email FROM customers)
GROUP BY email HAVING count(*) > 1"""))
def chk_email_unique(spark, sf_dir):
    """The dirty customers merged over the clean ones."""
    clean_ones = entity_rows(flat_sales(spark, sf_dir), CUSTOMERS, FLAT_ORDER)
    batch = _dirty_batch(spark, sf_dir, CUSTOMERS)
    merged = upsert(with_stamps(clean_ones, CUSTOMERS, FIRST), batch, CUSTOMERS, SECOND)
    return duplicate_violations(merged, CUSTOMERS, "email", "unique:email", batch)


# Date rows with a second key for the same day, as a wrong manual correction would leave them.
@query("chk_full_date_unique", with_(FLAT, f"""
SELECT 'dim_dates' AS table_name, 'unique:full_date' AS rule, {_UNIQUE.format(c='full_date')}
FROM (SELECT full_date FROM ({calendar('flat')})
      UNION ALL SELECT full_date FROM ({calendar('flat')}) WHERE is_weekend)
GROUP BY full_date HAVING count(*) > 1"""))
def chk_full_date_unique(spark, sf_dir):
    batch = all_entities(clean_rows(flat_sales(spark, sf_dir)), FLAT_ORDER)["dim_dates"]
    wrong = batch.filter("is_weekend").withColumn("date_id", -F.col("date_id"))
    return duplicate_violations(
        batch.unionByName(wrong), DIM_DATES, "full_date", "unique:full_date", batch
    )


@query("fk_orphans", with_(BATCHES + f""",
t_dates AS ({calendar('t')}), t_customers AS ({entity('customers', 't')}),
t_products AS ({entity('products', 't')}), t_orders AS ({entity('orders', 't')}),
b_orders AS ({entity('orders', 'b')}), b_items AS ({entity('order_items', 'b')})""",
"\nUNION ALL ".join(
    f"SELECT '{child}' AS table_name, 'references:{fk}' AS rule, 'error' AS severity, "
    f"CAST(c.{fk} AS VARCHAR) AS pk, CAST(count(*) AS VARCHAR) AS value "
    f"FROM {rows} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{fk} = c.{fk}) GROUP BY c.{fk}"
    for child, rows, fk, parent in [
        ("orders", "b_orders", "date_id", "t_dates"),
        ("orders", "b_orders", "customer_id", "t_customers"),
        ("order_items", "b_items", "sale_id", "t_orders"),
        ("order_items", "b_items", "product_id", "t_products"),
    ])))
def fk_orphans(spark, sf_dir):
    """Children of the later batch against the parents of the earlier one alone: what a load
    that does not bring its parents first would be refused for."""
    flat = flat_sales(spark, sf_dir)
    parents = all_entities(clean_rows(target_rows(flat)), FLAT_ORDER)
    batch = all_entities(clean_rows(batch_rows(flat)), FLAT_ORDER)
    return reference_violations(
        {name: batch[name] for name in ("orders", "order_items")}, parents
    )
