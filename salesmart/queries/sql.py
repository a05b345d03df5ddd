"""SQL building blocks of the checks: the flat sales rows, clean and dirty, and the entities."""

FLAT = """
priced AS (
  SELECT *, CAST(o_orderdate AS DATE) AS sale_date,
         CAST(p_retailprice AS DECIMAL(12,2)) AS original_price,
         CAST(round(l_discount * 100) AS INTEGER) AS pct
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey
), paid AS (
  SELECT *, CAST(original_price * CAST(100 - pct AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2))
                 AS DECIMAL(12,2)) AS unit_price
  FROM priced
), flat AS (
  SELECT sale_date,
         CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS item_id,
         l_orderkey AS sale_id,
         CAST(l_partkey AS INTEGER) AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         original_price, unit_price,
         CAST(original_price - unit_price AS DECIMAL(12,2)) AS discount_applied,
         concat(pct, '%') AS discount_percent,
         CASE WHEN l_discount > 0 THEN 'True' ELSE 'False' END AS discounted,
         CAST(CAST(l_quantity AS INTEGER) * unit_price AS DECIMAL(12,2)) AS item_total,
         o_orderpriority AS channel, l_linestatus AS channel_campaigns,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         p_name AS product_name, p_type AS category, p_brand AS brand, l_returnflag AS color,
         CAST(p_size AS VARCHAR) AS size, original_price AS catalog_price,
         CAST(original_price * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,2)) AS cost_price,
         o_custkey AS customer_id,
         CASE o_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Other'
              ELSE 'Unknown' END AS gender,
         c_mktsegment AS age_range,
         CAST(sale_date - INTERVAL 30 DAY AS DATE) AS signup_date,
         c_name AS first_name, n_name AS last_name,
         concat(lower(c_name), '@example.com') AS email,
         concat('R', n_regionkey) AS country,
         l_suppkey AS seq1, l_extendedprice AS seq2, l_orderkey * 7 + l_partkey AS h
  FROM paid
)"""

DIRTY = FLAT + """, dirty AS (
  SELECT CASE WHEN h % 97 = 0 THEN 'not-a-date' ELSE CAST(sale_date AS VARCHAR) END AS sale_date,
         item_id, sale_id, product_id,
         CASE WHEN h % 79 = 0 THEN 0 ELSE quantity END AS quantity,
         original_price,
         CAST(CASE WHEN h % 73 = 0 THEN -unit_price ELSE unit_price END AS DECIMAL(12,2))
           AS unit_price,
         CAST(CASE WHEN h % 19 = 0 THEN -1 ELSE discount_applied END AS DECIMAL(12,2))
           AS discount_applied,
         CASE WHEN h % 19 = 0 THEN '0%' WHEN h % 89 = 0 THEN NULL WHEN h % 83 = 0 THEN 'n/a'
              WHEN h % 67 = 0 THEN '150%' WHEN h % 17 = 0 THEN '-5%' WHEN h % 13 = 0 THEN '15.126%'
              ELSE discount_percent END AS discount_percent,
         CASE WHEN h % 61 = 0 THEN NULL WHEN h % 13 = 0 THEN '0' WHEN h % 11 = 0 THEN '2'
              ELSE discounted END AS discounted,
         item_total,
         CASE WHEN h % 29 = 0 THEN repeat('x', 60) ELSE channel END AS channel,
         channel_campaigns, total_amount,
         CASE WHEN h % 71 = 0 THEN NULL ELSE product_name END AS product_name,
         category, brand, color, size,
         CASE WHEN h % 23 = 0 THEN CAST('99999999999.99' AS DECIMAL(18,2))
              ELSE CAST(catalog_price AS DECIMAL(18,2)) END AS catalog_price,
         CAST(CASE WHEN h % 59 = 0 THEN catalog_price + 1 ELSE cost_price END AS DECIMAL(12,2))
           AS cost_price,
         CASE WHEN h % 101 = 0 THEN NULL WHEN h % 31 = 0 THEN customer_id + 1
              ELSE customer_id END AS customer_id,
         CASE WHEN h % 47 = 0 THEN 'X' ELSE gender END AS gender,
         age_range, signup_date,
         CASE WHEN h % 37 = 0 THEN 'Renamed' ELSE first_name END AS first_name,
         last_name,
         CASE WHEN h % 53 = 0 THEN 'shared@example.com' ELSE email END AS email,
         country, seq1, seq2, h, copy
  FROM flat JOIN (VALUES (1), (2)) copies(copy) ON copy = 1 OR h % 43 = 0
)"""

ORDER_FLAT = "item_id, product_id, seq1, seq2"
ORDER_DIRTY = "item_id, product_id, seq1, seq2, copy"

# The columns of the raw file and of the tables, their keys, and the form of a number.
RAW = (
    "sale_date, item_id, sale_id, product_id, quantity, original_price, unit_price, "
    "discount_applied, discount_percent, discounted, item_total, channel, channel_campaigns, "
    "total_amount, product_name, category, brand, color, size, catalog_price, cost_price, "
    "customer_id, gender, age_range, signup_date, first_name, last_name, email, country"
)
COLUMNS = {
    "customers": "customer_id, first_name, last_name, email, gender, age_range, signup_date, country",
    "products": "product_id, product_name, category, brand, color, size, catalog_price, cost_price",
    "orders": "sale_id, sale_date, date_id, customer_id, channel, channel_campaigns",
    "order_items": "item_id, sale_id, product_id, quantity, original_price, unit_price, "
    "discount_applied, discount_percent, discounted",
}
KEY = {"customers": "customer_id", "products": "product_id", "orders": "sale_id", "order_items": "item_id"}

DICTIONARY_COLUMNS = {
    "dim_dates": [
        "date_id", "full_date", "year", "month", "day", "day_of_week", "week_number", "quarter", "is_weekend", "is_holiday",
    ],
    **{name: columns.split(", ") for name, columns in COLUMNS.items()},
}

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
PERCENT = (
    "CASE WHEN regexp_matches(replace(discount_percent, '%', ''), '" + NUMBER + "') "
    "THEN TRY_CAST(replace(discount_percent, '%', '') AS DOUBLE) END"
)
FLAG = (
    "CASE WHEN lower(discounted) = 'true' THEN true WHEN lower(discounted) = 'false' THEN false "
    "WHEN regexp_matches(discounted, '" + NUMBER + "') THEN TRY_CAST(discounted AS DOUBLE) <> 0 END"
)
DAY = "TRY_CAST(sale_date AS DATE)"


def date_id(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def clean(source: str, name: str = "cleaned", where: str = "true") -> str:
    """A CTE with the cleaned rows of ``source``."""
    return (
        f"{name} AS (SELECT * REPLACE (coalesce({PERCENT}, 0.0) AS discount_percent, "
        f"coalesce({FLAG}, false) AS discounted), {date_id('sale_date')} AS date_id "
        f"FROM {source} WHERE {where})"
    )


def entity(table: str, source: str, order: str = ORDER_FLAT) -> str:
    """Rows of one table in ``source``: the first of a key, for order items the last."""
    columns, key = COLUMNS[table], KEY[table]
    if table == "order_items":
        order = ", ".join(f"{c} DESC" for c in order.split(", "))
        columns = columns.replace(
            "discount_percent", "CAST(discount_percent AS DECIMAL(5,2)) AS discount_percent"
        )
    return (
        f"SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"
    )


def calendar(source: str, weekend: str = "isodow(d) >= 6") -> str:
    return f"""SELECT {date_id('d')} AS date_id, d AS full_date,
       CAST(year(d) AS SMALLINT) AS year, CAST(month(d) AS SMALLINT) AS month,
       CAST(day(d) AS SMALLINT) AS day, dayname(d) AS day_of_week,
       CAST(weekofyear(d) AS SMALLINT) AS week_number, CAST(quarter(d) AS SMALLINT) AS quarter,
       {weekend} AS is_weekend, false AS is_holiday
FROM (SELECT DISTINCT sale_date AS d FROM {source} WHERE sale_date IS NOT NULL)"""


TOTAL = "CAST(quantity * unit_price AS DECIMAL(12,2)) AS item_total"

# The two overlapping batches and the times they are loaded at.
FIRST_TS = "TIMESTAMP '2025-06-16 06:00:00'"
SECOND_TS = "TIMESTAMP '2025-06-17 06:00:00'"
BATCHES = (
    FLAT
    + ", "
    + clean("flat", "t", "sale_date < DATE '1998-07-01'")
    + ", "
    + clean("flat", "b", "sale_date >= DATE '1998-01-01'")
)

# The later batch with corrections to sales, lines, prices and customers.
CHANGED = FLAT + """, changed AS (
  SELECT * REPLACE (
    CASE WHEN sale_id % 7 = 0 THEN CAST(sale_date + INTERVAL 31 DAY AS DATE) ELSE sale_date END AS sale_date,
    CASE WHEN sale_id % 5 = 0 THEN 'corrected' ELSE channel END AS channel,
    CASE WHEN h % 3 = 0 THEN quantity + 1 ELSE quantity END AS quantity,
    CAST(CASE WHEN h % 4 = 0 THEN unit_price + 1 ELSE unit_price END AS DECIMAL(12,2)) AS unit_price,
    CAST(CASE WHEN product_id % 3 = 0 THEN catalog_price + 5 ELSE catalog_price END AS DECIMAL(12,2))
      AS catalog_price,
    CAST(CASE WHEN product_id % 4 = 0 THEN cost_price + 1 ELSE cost_price END AS DECIMAL(12,2)) AS cost_price,
    CASE WHEN customer_id % 6 = 0 THEN 'moved' ELSE country END AS country)
  FROM flat WHERE sale_date >= DATE '1998-01-01'
), """ + clean("flat", "t", "sale_date < DATE '1998-07-01'") + ", " + clean("changed", "b")


def upserted(table: str, first: str = "t", second: str = "b") -> str:
    """SELECT over the table after loading ``first`` and then ``second``."""
    key = KEY[table]
    total = f", {TOTAL}" if table == "order_items" else ""
    names = ["created_at"] if table == "order_items" else ["created_at", "updated_at"]
    inserted = f"CASE WHEN o.{key} IS NULL THEN {SECOND_TS} ELSE {FIRST_TS} END"
    new = ", ".join(f"{inserted} AS {name}" for name in names)
    old = ", ".join(f"{FIRST_TS} AS {name}" for name in names)
    return f"""SELECT n.*{total}, {new}
FROM ({entity(table, second)}) n
     LEFT JOIN (SELECT DISTINCT {key} FROM {first}) o ON n.{key} = o.{key}
UNION ALL
SELECT o.*{total}, {old}
FROM ({entity(table, first)}) o WHERE o.{key} NOT IN (SELECT {key} FROM {second})"""


UPSERTED_DATES = f"""SELECT *, {FIRST_TS} AS created_at FROM ({calendar('t')})
UNION ALL
SELECT *, {SECOND_TS} AS created_at FROM ({calendar('b')})
WHERE date_id NOT IN (SELECT date_id FROM t)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
