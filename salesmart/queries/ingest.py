"""Sources, staging, cleaning and derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesmart.functions.dates import date_key, parse_run_date, resolve_run_dates
from salesmart.functions.values import (
    clean_flag,
    clean_percent,
    item_total,
    percent_is_bad,
    sale_product_key,
)
from salesmart.operators.merge import upsert
from salesmart.operators.profile import type_mapping
from salesmart.operators.quality import anomalous_amounts, anomalous_percents
from salesmart.plans.clean import clean_rows, load_status, sale_day, slice_days
from salesmart.plans.entities import all_entities, conform, entity_rows, project
from salesmart.plans.warehouse import Warehouse
from salesmart.queries import query
from salesmart.queries.load import FIRST
from salesmart.queries.sql import (
    DAY, DIRTY, FLAG, FLAT, ORDER_FLAT, PERCENT, RAW, TOTAL, COLUMNS, clean, date_id, entity, with_,
)
from salesmart.schemas import ORDERS, ORDER_ITEMS, RAW_NAMES, RECOMMENDED_SQL_TYPE, TABLES
from salesmart.session import scratch_path
from salesmart.sources.csv import read_sales_csv, typed_columns
from salesmart.sources.staging import preview, read_staged, stage_filtered, stage_raw
from salesmart.sources.testtables import FLAT_ORDER, dirty_sales, flat_sales

RUN_DAY = "19970823"
CSV_RECORDS = 1 << 18


# In a CSV file the text n/a means a missing value, and a price beyond its type is lost when typed.
@query("csv_scan", with_(DIRTY, f"""
SELECT * REPLACE (nullif(discount_percent, 'n/a') AS discount_percent,
                  CAST(CASE WHEN catalog_price < 10000000000 THEN catalog_price END
                       AS DECIMAL(12,2)) AS catalog_price)
FROM (SELECT {RAW} FROM dirty)"""))
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    # Compressed files are read whole, so each holds a bounded number of records.
    files = dirty_sales(spark, sf_dir).select(RAW_NAMES).write.option("maxRecordsPerFile", CSV_RECORDS)
    files.option("header", True).option("compression", "gzip").csv(path)
    return typed_columns(read_sales_csv(spark, path)).select(RAW_NAMES)


@query("stage_raw", with_(DIRTY, """
SELECT sale_date, count(*) AS n_rows, CAST(sum(quantity) AS BIGINT) AS quantity
FROM dirty GROUP BY sale_date"""))
def staged_raw(spark, sf_dir):
    dirty = dirty_sales(spark, sf_dir)
    path = stage_raw(dirty, scratch_path(spark, "raw"))
    staged = read_staged(spark, path, dirty.schema)
    return staged.groupBy("sale_date").agg(
        F.count("*").alias("n_rows"), F.sum("quantity").alias("quantity")
    )


@query("stage_roundtrip", with_(DIRTY, f"SELECT {RAW}, copy FROM dirty"))
def stage_roundtrip(spark, sf_dir):
    dirty = dirty_sales(spark, sf_dir)
    path = stage_raw(dirty, scratch_path(spark, "raw"))
    return read_staged(spark, path, dirty.schema).select(*RAW_NAMES, "copy")


@query("stage_filtered", with_(FLAT + ", " + clean("flat", where=(
    "sale_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'")), f"""
SELECT {RAW}, date_id FROM cleaned"""))
def staged_filtered(spark, sf_dir):
    days = resolve_run_dates([f"199801{d:02d}" for d in range(1, 32)])
    cleaned = clean_rows(slice_days(flat_sales(spark, sf_dir), days))
    path = stage_filtered(cleaned, scratch_path(spark, "filtered"))
    return read_staged(spark, path, cleaned.schema).select(*RAW_NAMES, "date_id")


@query("bootstrap_schema", with_(FLAT, """
SELECT 'dim_dates' AS table_name, CAST(11 AS BIGINT) AS n_columns, CAST(0 AS BIGINT) AS n_before,
       count(DISTINCT sale_date) AS n_after FROM flat
UNION ALL SELECT 'customers', 10, 0, count(DISTINCT customer_id) FROM flat
UNION ALL SELECT 'products', 10, 0, count(DISTINCT product_id) FROM flat
UNION ALL SELECT 'orders', 8, 0, count(DISTINCT sale_id) FROM flat
UNION ALL SELECT 'order_items', 11, 0, count(DISTINCT item_id) FROM flat"""))
def bootstrap_schema(spark, sf_dir):
    """Tables right after creation and after the first rows went in."""
    warehouse = Warehouse(spark, scratch_path(spark, "bootstrap"))
    warehouse.bootstrap()
    batch = all_entities(clean_rows(flat_sales(spark, sf_dir)), FLAT_ORDER)
    counts = []
    for name, table in TABLES.items():
        empty = warehouse.read(name)
        filled = upsert(empty, batch[name], table, FIRST)
        counts.append(
            filled.agg(F.count("*").alias("n_after")).select(
                F.lit(name).alias("table_name"),
                F.lit(len(empty.columns)).cast("bigint").alias("n_columns"),
                F.lit(empty.count()).cast("bigint").alias("n_before"),
                "n_after",
            )
        )
    return reduce(DataFrame.unionByName, counts)


@query("orders_preview", with_(FLAT + ", " + clean("flat"), f"""
SELECT * FROM ({entity('orders', 'cleaned')}) ORDER BY sale_id LIMIT 10"""))
def orders_preview(spark, sf_dir):
    rows = clean_rows(flat_sales(spark, sf_dir))
    return preview(entity_rows(rows, ORDERS, FLAT_ORDER), ["sale_id"])


@query("raw_preview", with_(FLAT, f"SELECT {RAW} FROM flat ORDER BY {ORDER_FLAT} LIMIT 10"))
def raw_preview(spark, sf_dir):
    return preview(flat_sales(spark, sf_dir), FLAT_ORDER).select(RAW_NAMES)


@query("parse_sale_date", with_(DIRTY, f"""
SELECT item_id, product_id, copy, sale_date AS sale_date_text, {DAY} AS sale_date FROM dirty"""))
def parse_sale_date(spark, sf_dir):
    df = dirty_sales(spark, sf_dir)
    return df.select(
        "item_id", "product_id", "copy", F.col("sale_date").alias("sale_date_text"),
        sale_day(df).alias("sale_date"),
    )


@query("daily_slice", with_(DIRTY, f"""
SELECT * REPLACE ({DAY} AS sale_date) FROM (SELECT {RAW}, copy FROM dirty)
WHERE {DAY} = DATE '1997-08-23'"""))
def daily_slice(spark, sf_dir):
    df = dirty_sales(spark, sf_dir).select(*RAW_NAMES, "copy")
    return slice_days(df, [parse_run_date(RUN_DAY)])


@query("backfill_slices", with_(FLAT, f"""
SELECT {date_id('sale_date')} AS date_id, item_id, sale_id, product_id, quantity, unit_price
FROM flat WHERE sale_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-28'"""))
def backfill_slices(spark, sf_dir):
    days = resolve_run_dates([f"199801{d:02d}" for d in range(1, 29)], default="20250616")
    return slice_days(flat_sales(spark, sf_dir), days).select(
        date_key(F.col("sale_date")).alias("date_id"),
        "item_id", "sale_id", "product_id", "quantity", "unit_price",
    )


@query("date_key", with_(DIRTY, f"""
SELECT item_id, product_id, copy, {date_id(DAY)} AS date_id FROM dirty"""))
def date_keys(spark, sf_dir):
    df = dirty_sales(spark, sf_dir)
    return df.select("item_id", "product_id", "copy", date_key(sale_day(df)).alias("date_id"))


@query("clean_percent", with_(DIRTY, f"""
SELECT item_id, product_id, copy, discount_percent AS percent_text,
       coalesce({PERCENT}, 0.0) AS discount_percent FROM dirty"""))
def cleaned_percent(spark, sf_dir):
    text = F.col("discount_percent")
    return dirty_sales(spark, sf_dir).select(
        "item_id", "product_id", "copy", text.alias("percent_text"),
        clean_percent(text).alias("discount_percent"),
    )


@query("percent_strict_rejects", with_(DIRTY, f"""
SELECT item_id, product_id, copy, discount_percent FROM dirty WHERE ({PERCENT}) IS NULL"""))
def percent_strict_rejects(spark, sf_dir):
    return dirty_sales(spark, sf_dir).filter(percent_is_bad(F.col("discount_percent"))).select(
        "item_id", "product_id", "copy", "discount_percent"
    )


@query("clean_discounted", with_(DIRTY, f"""
SELECT item_id, product_id, copy, discounted AS flag_text, coalesce({FLAG}, false) AS discounted,
       coalesce({FLAG}, true) AS discounted_missing_true FROM dirty"""))
def clean_discounted(spark, sf_dir):
    flag = F.col("discounted")
    return dirty_sales(spark, sf_dir).select(
        "item_id", "product_id", "copy", flag.alias("flag_text"),
        clean_flag(flag).alias("discounted"),
        clean_flag(flag, null_as=True).alias("discounted_missing_true"),
    )


@query("nan_to_null", with_(DIRTY, """
SELECT item_id, product_id, copy, CASE WHEN h % 6 > 1 THEN CAST(seq2 AS DOUBLE) END AS amount FROM dirty"""))
def nan_cells(spark, sf_dir):
    """A float column with NaN in some rows and NULL in others, cleaned with the rest of the row."""
    dirty = dirty_sales(spark, sf_dir)
    holed = F.when(F.col("h") % 6 == 0, F.lit(float("nan"))).when(F.col("h") % 6 > 1, F.col("seq2").cast("double"))
    rows = dirty.withColumn("amount", holed).withColumn("sale_date", sale_day(dirty))
    return clean_rows(rows).select("item_id", "product_id", "copy", "amount")


@query("project_order_items", with_(FLAT + ", " + clean("flat"), f"""
SELECT {COLUMNS['order_items']} FROM (
  SELECT * REPLACE (CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent) FROM cleaned)"""))
def project_order_items(spark, sf_dir):
    return conform(project(clean_rows(flat_sales(spark, sf_dir)), ORDER_ITEMS), ORDER_ITEMS)


@query("item_total", with_(FLAT, f"SELECT item_id, product_id, seq1, seq2, {TOTAL} FROM flat"))
def item_totals(spark, sf_dir):
    total = item_total(F.col("quantity"), F.col("unit_price"))
    return flat_sales(spark, sf_dir).select(*FLAT_ORDER, total.alias("item_total"))


@query("sale_product_key", with_(FLAT, """
SELECT item_id, sale_id || '_' || product_id AS sale_product FROM flat"""))
def sale_product(spark, sf_dir):
    key = sale_product_key(F.col("sale_id"), F.col("product_id"))
    return flat_sales(spark, sf_dir).select("item_id", key.alias("sale_product"))


@query("anomaly_price_qty", with_(DIRTY, """
SELECT item_id, product_id, copy, quantity, unit_price FROM dirty
WHERE quantity <= 0 OR unit_price < 0"""))
def anomaly_price_qty(spark, sf_dir):
    return anomalous_amounts(dirty_sales(spark, sf_dir)).select(
        "item_id", "product_id", "copy", "quantity", "unit_price"
    )


@query("anomaly_discount", with_(DIRTY, f"""
SELECT * FROM (SELECT item_id, product_id, copy, coalesce({PERCENT}, 0.0) AS discount_percent FROM dirty)
WHERE discount_percent > 100 OR discount_percent < 0"""))
def anomaly_discount(spark, sf_dir):
    percent = clean_percent(F.col("discount_percent"))
    df = dirty_sales(spark, sf_dir).withColumn("discount_percent", percent)
    return anomalous_percents(df, F.col("discount_percent")).select(
        "item_id", "product_id", "copy", "discount_percent"
    )


@query("load_status", with_(FLAT, f"""
SELECT {date_id('d')} AS run_date, CASE WHEN count(sale_date) > 0 THEN 'SUCCESS' ELSE 'NO_DATA' END
         AS status, count(sale_date) AS n_rows
FROM (SELECT CAST(d AS DATE) AS d FROM
        (SELECT min(sale_date) - INTERVAL 7 DAY AS a, max(sale_date) + INTERVAL 7 DAY AS z FROM flat),
        unnest(generate_series(a, z, INTERVAL 1 DAY)) AS days(d))
     LEFT JOIN flat ON sale_date = d
GROUP BY d"""))
def load_statuses(spark, sf_dir):
    """Status of a run for every day from a week before the first sale to a week after the last."""
    flat = flat_sales(spark, sf_dir)
    counts = flat.groupBy(date_key(F.col("sale_date")).alias("run_date")).agg(
        F.count("*").alias("n_rows")
    )
    span = flat.agg(F.min("sale_date").alias("a"), F.max("sale_date").alias("z"))
    days = span.select(
        F.explode(F.sequence(F.date_sub("a", 7), F.date_add("z", 7))).alias("d")
    ).select(date_key(F.col("d")).alias("run_date"))
    return load_status(counts, days)




# Type of every raw column as read, and the SQL type recommended for it.
_MAPPING = """(VALUES
  (0, 'sale_date', 'date', 'DATE'),
  (1, 'item_id', 'bigint', 'INTEGER'),
  (2, 'sale_id', 'bigint', 'INTEGER'),
  (3, 'product_id', 'int', 'INTEGER'),
  (4, 'quantity', 'int', 'INTEGER'),
  (5, 'original_price', 'decimal(12,2)', 'NUMERIC(10,2)'),
  (6, 'unit_price', 'decimal(12,2)', 'NUMERIC(10,2)'),
  (7, 'discount_applied', 'decimal(12,2)', 'NUMERIC(10,2)'),
  (8, 'discount_percent', 'string', 'NUMERIC(5,4)'),
  (9, 'discounted', 'string', 'BOOLEAN'),
  (10, 'item_total', 'decimal(12,2)', 'NUMERIC(10,2)'),
  (11, 'channel', 'string', 'VARCHAR(50)'),
  (12, 'channel_campaigns', 'string', 'VARCHAR(100)'),
  (13, 'total_amount', 'decimal(12,2)', 'NUMERIC(12,2)'),
  (14, 'product_name', 'string', 'VARCHAR(255)'),
  (15, 'category', 'string', 'VARCHAR(100)'),
  (16, 'brand', 'string', 'VARCHAR(100)'),
  (17, 'color', 'string', 'VARCHAR(50)'),
  (18, 'size', 'string', 'VARCHAR(20)'),
  (19, 'catalog_price', 'decimal(12,2)', 'NUMERIC(10,2)'),
  (20, 'cost_price', 'decimal(12,2)', 'NUMERIC(10,2)'),
  (21, 'customer_id', 'bigint', 'INTEGER'),
  (22, 'gender', 'string', 'VARCHAR(10)'),
  (23, 'age_range', 'string', 'VARCHAR(20)'),
  (24, 'signup_date', 'date', 'DATE'),
  (25, 'first_name', 'string', 'VARCHAR(100)'),
  (26, 'last_name', 'string', 'VARCHAR(100)'),
  (27, 'email', 'string', 'VARCHAR(255)'),
  (28, 'country', 'string', 'VARCHAR(100)')
) m(ord, column_name, source_type, sql_type)"""


@query("type_mapping", with_(FLAT + ", fill AS (SELECT unnest(['" + "', '".join(RAW.split(", ")) + "']) AS column_name, unnest(["
                             + ", ".join(f"count({c})" for c in RAW.split(", ")) + "]) AS n_non_null FROM flat)", f"""
SELECT CAST(ord AS INTEGER) AS ord, column_name, source_type, sql_type, n_non_null
FROM {_MAPPING} JOIN fill USING (column_name)"""))
def type_mappings(spark, sf_dir):
    return type_mapping(flat_sales(spark, sf_dir).select(RAW_NAMES), RECOMMENDED_SQL_TYPE)
