"""The profile of the raw file, here the dirty one."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesmart.operators import profile
from salesmart.operators.duplicates import (
    duplicate_key_examples, duplicate_keys, duplicate_row_examples, duplicate_rows,
)
from salesmart.operators.sketches import merged_cardinality, period_sketches
from salesmart.plans.clean import sale_day
from salesmart.queries import query
from salesmart.queries.sql import DAY, DIRTY, ORDER_DIRTY, RAW, with_
from salesmart.schemas import RAW_NAMES
from salesmart.session import materialise
from salesmart.sources.testtables import DIRTY_ORDER, dirty_sales

_TYPES = {
    "sale_date": "string", "item_id": "bigint", "sale_id": "bigint", "product_id": "int",
    "quantity": "int", "original_price": "decimal(12,2)", "unit_price": "decimal(12,2)",
    "discount_applied": "decimal(12,2)", "item_total": "decimal(12,2)",
    "total_amount": "decimal(12,2)", "catalog_price": "decimal(18,2)",
    "cost_price": "decimal(12,2)", "customer_id": "bigint", "signup_date": "date",
}
_NUMERIC = [c for c in RAW_NAMES if _TYPES.get(c, "string").startswith(("int", "bigint", "decimal"))]
_TEXT = [c for c in RAW_NAMES if _TYPES.get(c, "string") == "string"]


def _raw(spark, sf_dir):
    return dirty_sales(spark, sf_dir).select(RAW_NAMES)


def _per_column(select: str, columns=RAW_NAMES, source: str = "dirty") -> str:
    """``select`` for every column; {c} is its name, {i} its position, {t} its type."""
    return "\nUNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ord, '{c}' AS column_name, "
        + select.format(c=c, i=i, t=_TYPES.get(c, "string"))
        + f" FROM {source}"
        for i, c in enumerate(columns)
    )


@query("shape", with_(DIRTY, "SELECT count(*) AS n_rows, CAST(29 AS BIGINT) AS n_columns FROM dirty"))
def shape(spark, sf_dir):
    return profile.shape(_raw(spark, sf_dir))


@query("structure", with_(DIRTY, _per_column("'{t}' AS data_type, count({c}) AS n_non_null")))
def structure(spark, sf_dir):
    return profile.structure(_raw(spark, sf_dir))


def _describe_sql(columns, source: str, digits: int) -> str:
    rounded = (
        "count({c}) AS n, round(CAST(sum({c}) AS DOUBLE) / count({c}), 4) AS mean, "
        "round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        "round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25, "
        "round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50, "
        "round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75, "
        "CAST(max({c}) AS DOUBLE) AS max"
    )
    return _per_column(rounded.replace(", 4)", f", {digits})"), columns, source)


def _rounded(described, digits: int):
    """Floating sums differ in the last digits with the order of summation."""
    return described.select(
        *[
            F.round(c, digits).alias(c) if c in ("mean", "std", "p25", "p50", "p75") else c
            for c in described.columns
        ]
    )


@query("describe_numeric", with_(DIRTY, _describe_sql(_NUMERIC, "dirty", 2)))
def describe_numeric(spark, sf_dir):
    columns = profile.numeric_columns(_raw(spark, sf_dir))
    stored = materialise(_raw(spark, sf_dir).select(columns), "raw")
    return _rounded(profile.describe_numeric(stored), 2)


@query("describe_text", with_(DIRTY, _per_column(
    "count({c}) AS n, count(DISTINCT {c}) AS n_unique, "
    "(SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
    "(SELECT count(*) FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq",
    _TEXT) + f"""
UNION ALL SELECT CAST({len(_TEXT)} AS INTEGER), 'nothing', 0, 0, NULL, NULL"""))
def describe_text(spark, sf_dir):
    """With a column that has no value at all."""
    return profile.describe_text(_raw(spark, sf_dir).withColumn("nothing", F.lit(None).cast("string")))


# Prices as floating numbers, some of them NaN, and as decimals of more than 18 digits.
@query("describe_float", with_(DIRTY, _describe_sql(["price", "share", "wide"], """(
SELECT CAST(unit_price AS DOUBLE) AS price,
       CASE WHEN quantity % 3 > 0 THEN CAST(cost_price AS DOUBLE) / 8 END AS share,
       CAST(catalog_price AS DECIMAL(22,2)) AS wide FROM dirty) AS dirty""", 2)))
def describe_float(spark, sf_dir):
    price = F.col("cost_price").cast("double") / 8
    frame = _raw(spark, sf_dir).select(
        F.col("unit_price").cast("double").alias("price"),
        F.when(F.col("quantity") % 3 > 0, price).otherwise(F.lit(float("nan"))).alias("share"),
        F.col("catalog_price").cast("decimal(22,2)").alias("wide"),
    )
    return _rounded(profile.describe_numeric(materialise(frame, "floats")), 2)


@query("cardinality", with_(DIRTY, _per_column(
    "count(DISTINCT {c}) AS n_distinct, count(*) AS n_rows, "
    "round_even(CAST(count(DISTINCT {c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 1) AS pct")))
def cardinality(spark, sf_dir):
    return profile.cardinality(_raw(spark, sf_dir))


# SQL has no sketches; what it can say is that the estimate is within 5 % of the exact count.
_CLOSE = "count(*) AS n_rows, count(DISTINCT {c}) AS n_distinct, true AS close"


def _close(estimated, exact):
    """Exact counts, and whether the estimates are close to them."""
    exact = exact.select("ord", "n_distinct", "n_rows")
    estimated = estimated.select("ord", "column_name", F.col("n_distinct").alias("_estimate"))
    close = F.abs(F.col("_estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    return exact.join(estimated, "ord").select("ord", "column_name", "n_rows", "n_distinct", close.alias("close"))


@query("cardinality_approx", with_(DIRTY, _per_column(_CLOSE)))
def cardinality_approx(spark, sf_dir):
    """Estimates of one pass, held against the exact counts."""
    rows = materialise(_raw(spark, sf_dir), "raw")
    return _close(profile.cardinality_approx(rows), profile.cardinality(rows))


_HISTORY = ["item_id", "sale_id", "product_id", "quantity", "unit_price", "customer_id", "signup_date", "email", "first_name"]


@query("cardinality_history", with_(DIRTY + f", years AS (SELECT * FROM dirty WHERE year({DAY}) IN (1995, 1997, 1998))",
                                    _per_column(_CLOSE, _HISTORY, "years")))
def cardinality_history(spark, sf_dir):
    """Sketches per month, merged for three years, held against the exact counts."""
    rows = dirty_sales(spark, sf_dir)
    rows = rows.withColumn("_day", sale_day(rows)).filter("_day IS NOT NULL")
    rows = materialise(rows.select(*_HISTORY, F.expr("year(_day) * 100 + month(_day)").alias("period")), "history")
    sketches = materialise(period_sketches(rows, _HISTORY), "sketches")
    years = F.expr("period div 100").isin(1995, 1997, 1998)
    return _close(merged_cardinality(sketches.filter(years)), profile.cardinality(rows.filter(years).select(_HISTORY)))


_NULLS = "count(*) FILTER (WHERE {c} IS NULL) AS n_null"
_PCT = "CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS pct_null"


@query("null_report", with_(DIRTY, _per_column(f"count(*) AS n_rows, {_NULLS}, {_PCT}")))
def null_report(spark, sf_dir):
    return profile.null_report(_raw(spark, sf_dir))


@query("null_alert", with_(DIRTY, "SELECT * FROM (" + _per_column(
    f"count(*) AS n_rows, {_NULLS}, CAST(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in RAW_NAMES)
    + f" AS BIGINT) AS n_null_total, {_PCT}") + ") WHERE n_null > 0"))
def null_alert(spark, sf_dir):
    return profile.null_alert(_raw(spark, sf_dir))


_EXCESS = (
    "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_excess, "
    "CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100 AS pct "
    "FROM (SELECT count(*) AS n FROM dirty GROUP BY {keys})"
)


@query("dup_rows", with_(DIRTY, _EXCESS.format(keys=RAW)))
def dup_rows(spark, sf_dir):
    # The flat rows come out of a join by order, which equal rows share.
    return duplicate_rows(_raw(spark, sf_dir), RAW_NAMES, dealt=True)


@query("dup_row_examples", with_(DIRTY, f"""
SELECT {RAW} FROM dirty QUALIFY count(*) OVER (PARTITION BY {RAW}) > 1
ORDER BY {', '.join(c + ' ASC NULLS LAST' for c in RAW_NAMES)} LIMIT 10"""))
def dup_row_examples(spark, sf_dir):
    return duplicate_row_examples(_raw(spark, sf_dir), RAW_NAMES, dealt=True)


@query("dup_business_key", with_(DIRTY, _EXCESS.format(keys="sale_id, product_id")))
def dup_business_key(spark, sf_dir):
    return duplicate_keys(_raw(spark, sf_dir), ["sale_id", "product_id"])


@query("dup_key_examples", with_(DIRTY, f"""
SELECT {RAW} FROM (SELECT * FROM dirty
                   QUALIFY count(*) OVER (PARTITION BY sale_id, product_id) > 1
                   ORDER BY sale_id NULLS LAST, product_id NULLS LAST, {ORDER_DIRTY} LIMIT 10)"""))
def dup_key_examples(spark, sf_dir):
    df = dirty_sales(spark, sf_dir)
    return duplicate_key_examples(df, ["sale_id", "product_id"], DIRTY_ORDER).select(RAW_NAMES)


@query("distinct_entities", with_(DIRTY, """
SELECT count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_name) AS n_product_names
FROM dirty"""))
def distinct_entities(spark, sf_dir):
    return profile.distinct_entities(_raw(spark, sf_dir))


_DEPENDENCIES = {
    "customer_id": ["first_name", "last_name", "email", "gender", "age_range", "signup_date", "country"],
    "product_id": ["product_name", "category", "brand", "color", "size", "catalog_price", "cost_price"],
}


@query("fd_violations", with_(DIRTY, "\nUNION ALL ".join(
    f"SELECT '{k}' AS key_column, '{a}' AS attribute, count(*) FILTER (WHERE n > 1) AS n_violating_keys, "
    f"count(*) AS n_keys FROM (SELECT count(DISTINCT {a}) AS n FROM dirty WHERE {k} IS NOT NULL GROUP BY {k})"
    for k, attributes in _DEPENDENCIES.items() for a in attributes)))
def fd_violations(spark, sf_dir):
    return profile.dependency_violations(_raw(spark, sf_dir), _DEPENDENCIES)


_PRICES = """SELECT product_name, min(unit_price) AS min_price, max(unit_price) AS max_price,
       CAST(sum(unit_price) AS DOUBLE) / CAST(count(unit_price) AS DOUBLE) AS mean_price,
       count(unit_price) AS n_prices, max(unit_price) - min(unit_price) AS variation
FROM dirty WHERE product_name IS NOT NULL GROUP BY product_name"""


@query("product_price_stats", with_(DIRTY, f"""
SELECT * REPLACE (CAST(variation AS DECIMAL(13,2)) AS variation) FROM ({_PRICES})"""))
def product_price_stats(spark, sf_dir):
    return profile.product_price_stats(_raw(spark, sf_dir))


@query("price_variation_count", with_(DIRTY, f"""
SELECT count(*) FILTER (WHERE variation > 0) AS n_products_with_variation FROM ({_PRICES})"""))
def price_variation_count(spark, sf_dir):
    return profile.price_variation_count(_raw(spark, sf_dir))


_ORDERS = """SELECT sale_id, count(DISTINCT customer_id) AS n_customers,
       count(DISTINCT sale_date) AS n_dates, count(product_name) AS n_lines
FROM dirty GROUP BY sale_id"""


@query("order_analysis", with_(DIRTY, _ORDERS))
def order_analysis(spark, sf_dir):
    return profile.order_analysis(_raw(spark, sf_dir))


@query("order_analysis_describe", with_(DIRTY + f", per_order AS ({_ORDERS})", _describe_sql(
    ["n_customers", "n_dates", "n_lines"], "per_order", 4)))
def order_analysis_describe(spark, sf_dir):
    counts = profile.order_analysis(_raw(spark, sf_dir)).drop("sale_id")
    return _rounded(profile.describe_numeric(materialise(counts, "per_order")), 4)


@query("order_conflicts", with_(DIRTY, f"""
SELECT count(*) FILTER (WHERE n_customers > 1) AS n_multi_customer, count(*) FILTER (WHERE n_dates > 1) AS n_multi_date
FROM ({_ORDERS})"""))
def order_conflicts(spark, sf_dir):
    return profile.order_conflicts(_raw(spark, sf_dir))


@query("date_range", with_(DIRTY, f"""
SELECT count(*) FILTER (WHERE {DAY} IS NULL) AS n_invalid, min({DAY}) AS first_date, max({DAY}) AS last_date
FROM dirty"""))
def date_range(spark, sf_dir):
    df = _raw(spark, sf_dir)
    return profile.date_range(sale_day(df), df)


@query("nonpositive_counts", with_(DIRTY, """
SELECT count(*) FILTER (WHERE unit_price <= 0) AS n_price_nonpositive, count(*) FILTER (WHERE quantity <= 0) AS n_quantity_nonpositive
FROM dirty"""))
def nonpositive_counts(spark, sf_dir):
    return profile.nonpositive_counts(_raw(spark, sf_dir))
