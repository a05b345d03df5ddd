"""The 29-column sales file built from the test tables, clean and with injected defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmart.schemas import PRODUCTS, RAW_NAMES, Table

FLAT_ORDER = ["item_id", "product_id", "seq1", "seq2"]
DIRTY_ORDER = [*FLAT_ORDER, "copy"]
TARGET_END = "1998-07-01"
BATCH_START = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Lines of large tables that one task takes after the last join.
TASK_LINES = 1 << 18


def flat_sales(spark: SparkSession, sf_dir: str, by: str = "sale_id") -> DataFrame:
    """One row per order line with the columns of the raw file, file order and ``h``.

    The last join is by order or, with ``by="product_id"``, by product: its rows then lie together,
    so that what is grouped by it sends few rows.
    """
    # Values are brought to their short types before they are shuffled, and lines without the texts
    # of the side that is joined last. Nations, a few rows, meet the joined rows.
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderpriority",
        "cast(o_orderdate as date) as sale_date",
        "cast(o_totalprice as decimal(12,2)) as total_amount",
    )
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_type", "p_brand", "p_size",
        "cast(p_retailprice as decimal(12,2)) as original_price",
    )
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "cast(round(l_discount * 100) as int) as pct", "l_discount > 0 as has_discount",
        "l_linestatus", "l_returnflag", "cast(l_quantity as int) as quantity",
    )
    sold_to = orders.join(customers, orders.o_custkey == customers.c_custkey)
    with_part, with_order = lines.l_partkey == parts.p_partkey, lines.l_orderkey == sold_to.o_orderkey
    if by == "product_id":
        joined = lines.join(sold_to, with_order).join(parts, with_part)
    else:
        joined = _dealt(lines.join(parts, with_part), lines.count(), "l_orderkey").join(sold_to, with_order)
    priced = joined.join(F.broadcast(nations), joined.c_nationkey == nations.n_nationkey).selectExpr(
        "*",
        "cast(original_price * cast(100 - pct as decimal(5,0)) * cast(0.01 as decimal(3,2))"
        " as decimal(12,2)) as unit_price",
    )
    return priced.selectExpr(
        "sale_date",
        "l_orderkey * 10 + l_linenumber as item_id",
        "l_orderkey as sale_id",
        "cast(l_partkey as int) as product_id",
        "quantity",
        "original_price",
        "unit_price",
        "cast(original_price - unit_price as decimal(12,2)) as discount_applied",
        "concat(pct, '%') as discount_percent",
        "case when has_discount then 'True' else 'False' end as discounted",
        "cast(quantity * unit_price as decimal(12,2)) as item_total",
        "o_orderpriority as channel",
        "l_linestatus as channel_campaigns",
        "total_amount",
        "p_name as product_name",
        "p_type as category",
        "p_brand as brand",
        "l_returnflag as color",
        "cast(p_size as string) as size",
        "original_price as catalog_price",
        "cast(original_price * cast(0.6 as decimal(2,1)) as decimal(12,2)) as cost_price",
        "o_custkey as customer_id",
        "case o_custkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'Other'"
        " else 'Unknown' end as gender",
        "c_mktsegment as age_range",
        "date_sub(sale_date, 30) as signup_date",
        "c_name as first_name",
        "n_name as last_name",
        "concat(lower(c_name), '@example.com') as email",
        "concat('R', n_regionkey) as country",
        "l_suppkey as seq1",
        "l_extendedprice as seq2",
        "l_orderkey * 7 + l_partkey as h",
    )


def by_key(tab: Table) -> str:
    """Which of the flat frame's keys brings the rows of one key of ``tab`` together best."""
    return "product_id" if tab is PRODUCTS else "sale_id"


def _dealt(lines: DataFrame, n_lines: int, key: str) -> DataFrame:
    """Large tables in parts of bounded size, whatever the session's number of them; an order is small,
    so no part is much larger than others."""
    parts = line_parts(lines.sparkSession, n_lines)
    return lines.repartition(parts, key) if parts else lines


def line_parts(spark: SparkSession, n_lines: int) -> int | None:
    """How many parts large tables are dealt into, none for small ones."""
    parts = n_lines // TASK_LINES
    return None if parts < 2 else max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))


def dirty_sales(spark: SparkSession, sf_dir: str, by: str = "sale_id") -> DataFrame:
    """``flat_sales`` with defects placed by ``h``; some rows are present twice."""
    changes = {
        "sale_date": "case when h % 97 = 0 then 'not-a-date' else cast(sale_date as string) end",
        "quantity": "case when h % 79 = 0 then 0 else quantity end",
        "unit_price": "case when h % 73 = 0 then cast(-unit_price as decimal(12,2))"
        " else unit_price end",
        "discount_applied": "case when h % 19 = 0 then cast(-1 as decimal(12,2))"
        " else discount_applied end",
        "discount_percent": "case when h % 19 = 0 then '0%' when h % 89 = 0 then null"
        " when h % 83 = 0 then 'n/a' when h % 67 = 0 then '150%' when h % 17 = 0 then '-5%'"
        " when h % 13 = 0 then '15.126%' else discount_percent end",
        "discounted": "case when h % 61 = 0 then null when h % 13 = 0 then '0' when h % 11 = 0 then '2' else discounted end",
        "channel": "case when h % 29 = 0 then repeat('x', 60) else channel end",
        "product_name": "case when h % 71 = 0 then null else product_name end",
        "catalog_price": "case when h % 23 = 0 then cast('99999999999.99' as decimal(18,2))"
        " else cast(catalog_price as decimal(18,2)) end",
        "cost_price": "case when h % 59 = 0 then cast(catalog_price + 1 as decimal(12,2))"
        " else cost_price end",
        "customer_id": "case when h % 101 = 0 then null when h % 31 = 0 then customer_id + 1"
        " else customer_id end",
        "gender": "case when h % 47 = 0 then 'X' else gender end",
        "first_name": "case when h % 37 = 0 then 'Renamed' else first_name end",
        "email": "case when h % 53 = 0 then 'shared@example.com' else email end",
    }
    return flat_sales(spark, sf_dir, by).selectExpr(
        *[f"{changes[c]} as {c}" if c in changes else c for c in RAW_NAMES],
        "seq1",
        "seq2",
        "h",
        "explode(case when h % 43 = 0 then array(1, 2) else array(1) end) as copy",
    )


def target_rows(flat: DataFrame) -> DataFrame:
    """The earlier of two overlapping batches."""
    return flat.filter(F.col("sale_date") < F.lit(TARGET_END).cast("date"))


def batch_rows(flat: DataFrame) -> DataFrame:
    """The later of two overlapping batches."""
    return flat.filter(F.col("sale_date") >= F.lit(BATCH_START).cast("date"))


def changed_batch(flat: DataFrame) -> DataFrame:
    """The later batch with corrections: sales a month later or through another channel, other
    quantities, unit prices, catalog and cost prices, and customers who moved."""
    changes = {
        "sale_date": "case when sale_id % 7 = 0 then date_add(sale_date, 31) else sale_date end",
        "channel": "case when sale_id % 5 = 0 then 'corrected' else channel end",
        "quantity": "case when h % 3 = 0 then quantity + 1 else quantity end",
        "unit_price": "case when h % 4 = 0 then cast(unit_price + 1 as decimal(12,2)) else unit_price end",
        "catalog_price": "case when product_id % 3 = 0 then cast(catalog_price + 5 as decimal(12,2))"
        " else catalog_price end",
        "cost_price": "case when product_id % 4 = 0 then cast(cost_price + 1 as decimal(12,2)) else cost_price end",
        "country": "case when customer_id % 6 = 0 then 'moved' else country end",
    }
    return batch_rows(flat).selectExpr(*[f"{changes[c]} as {c}" if c in changes else c for c in flat.columns])
