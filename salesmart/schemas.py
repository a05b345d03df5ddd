"""Column lists, types, keys and comments of the raw file and the five mart tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

SCHEMA_COMMENT = "Sales mart: normalised sales data of the shop"

PRICE = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)

# The 29 columns of the raw sales file in file order, with the type each one
# is read into and the SQL type the type-mapping report recommends for it.
RAW_COLUMNS: list[tuple[str, T.DataType, str]] = [
    ("sale_date", T.StringType(), "DATE"),
    ("item_id", T.LongType(), "INTEGER"),
    ("sale_id", T.LongType(), "INTEGER"),
    ("product_id", T.IntegerType(), "INTEGER"),
    ("quantity", T.IntegerType(), "INTEGER"),
    ("original_price", PRICE, "NUMERIC(10,2)"),
    ("unit_price", PRICE, "NUMERIC(10,2)"),
    ("discount_applied", PRICE, "NUMERIC(10,2)"),
    ("discount_percent", T.StringType(), "NUMERIC(5,4)"),
    ("discounted", T.StringType(), "BOOLEAN"),
    ("item_total", PRICE, "NUMERIC(10,2)"),
    ("channel", T.StringType(), "VARCHAR(50)"),
    ("channel_campaigns", T.StringType(), "VARCHAR(100)"),
    ("total_amount", PRICE, "NUMERIC(12,2)"),
    ("product_name", T.StringType(), "VARCHAR(255)"),
    ("category", T.StringType(), "VARCHAR(100)"),
    ("brand", T.StringType(), "VARCHAR(100)"),
    ("color", T.StringType(), "VARCHAR(50)"),
    ("size", T.StringType(), "VARCHAR(20)"),
    ("catalog_price", PRICE, "NUMERIC(10,2)"),
    ("cost_price", PRICE, "NUMERIC(10,2)"),
    ("customer_id", T.LongType(), "INTEGER"),
    ("gender", T.StringType(), "VARCHAR(10)"),
    ("age_range", T.StringType(), "VARCHAR(20)"),
    ("signup_date", T.DateType(), "DATE"),
    ("first_name", T.StringType(), "VARCHAR(100)"),
    ("last_name", T.StringType(), "VARCHAR(100)"),
    ("email", T.StringType(), "VARCHAR(255)"),
    ("country", T.StringType(), "VARCHAR(100)"),
]
RAW_NAMES: list[str] = [name for name, _, _ in RAW_COLUMNS]
RAW_TYPES: dict[str, T.DataType] = {name: dtype for name, dtype, _ in RAW_COLUMNS}
RECOMMENDED_SQL_TYPE: dict[str, str] = {name: sql for name, _, sql in RAW_COLUMNS}

# The file is scanned with every column as text; typing happens in expressions, so that a bad
# value becomes a counted violation instead of a failed or silently shifted row.
RAW_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_NAMES])


@dataclass(frozen=True)
class Table:
    """One mart table: its columns, key, upsert behaviour and constraints."""

    name: str
    comment: str
    key: str
    columns: dict[str, T.DataType]
    update_columns: tuple[str, ...]
    stamps: tuple[str, ...]
    generated: dict[str, T.DataType] = field(default_factory=dict)
    not_null: tuple[str, ...] = ()
    varchar: dict[str, int] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)

    @property
    def column_names(self) -> list[str]:
        return list(self.columns)

    @property
    def schema(self) -> T.StructType:
        """Full stored schema: loaded columns, generated columns, then load timestamps."""
        fields = [
            T.StructField(name, dtype, True, {"comment": COLUMN_COMMENTS[name]})
            for name, dtype in {**self.columns, **self.generated}.items()
        ]
        fields += [
            T.StructField(name, T.TimestampNTZType(), True, {"comment": COLUMN_COMMENTS[name]})
            for name in self.stamps
        ]
        return T.StructType(fields)


COLUMN_COMMENTS: dict[str, str] = {
    "date_id": "calendar day as an integer yyyymmdd",
    "full_date": "calendar day",
    "year": "calendar year",
    "month": "month of the year, 1 to 12",
    "day": "day of the month",
    "day_of_week": "English weekday name",
    "week_number": "ISO week number",
    "quarter": "quarter of the year, 1 to 4",
    "is_weekend": "Saturday or Sunday",
    "is_holiday": "public holiday, false until enriched",
    "customer_id": "customer identifier",
    "first_name": "first name",
    "last_name": "last name",
    "email": "e-mail address, unique over customers",
    "gender": "declared gender",
    "age_range": "age bracket",
    "signup_date": "day the customer signed up",
    "country": "country of the customer",
    "product_id": "product identifier",
    "product_name": "product name",
    "category": "product category",
    "brand": "product brand",
    "color": "product colour",
    "size": "product size",
    "catalog_price": "list price",
    "cost_price": "cost price, at most the list price",
    "sale_id": "order identifier",
    "sale_date": "day of the order",
    "channel": "sales channel",
    "channel_campaigns": "campaign of the channel",
    "item_id": "order line identifier",
    "quantity": "units sold",
    "original_price": "unit price before discount",
    "unit_price": "unit price paid",
    "discount_applied": "discount amount per unit",
    "discount_percent": "discount in percent, 0 to 100",
    "discounted": "whether a discount was applied",
    "item_total": "generated: quantity times unit price",
    "created_at": "time of the load that inserted the row",
    "updated_at": "time of the load that inserted the row; updates keep it",
}

DIM_DATES = Table(
    name="dim_dates",
    comment="Calendar dimension, one row per day seen in the sales",
    key="date_id",
    columns={
        "date_id": T.IntegerType(),
        "full_date": T.DateType(),
        "year": T.ShortType(),
        "month": T.ShortType(),
        "day": T.ShortType(),
        "day_of_week": T.StringType(),
        "week_number": T.ShortType(),
        "quarter": T.ShortType(),
        "is_weekend": T.BooleanType(),
        "is_holiday": T.BooleanType(),
    },
    update_columns=(),
    stamps=("created_at",),
    not_null=("full_date", "year", "month", "day"),
    varchar={"day_of_week": 10},
)

CUSTOMERS = Table(
    name="customers",
    comment="One row per customer",
    key="customer_id",
    columns={
        "customer_id": T.LongType(),
        "first_name": T.StringType(),
        "last_name": T.StringType(),
        "email": T.StringType(),
        "gender": T.StringType(),
        "age_range": T.StringType(),
        "signup_date": T.DateType(),
        "country": T.StringType(),
    },
    update_columns=(
        "first_name", "last_name", "email", "gender", "age_range", "signup_date", "country",
    ),
    stamps=("created_at", "updated_at"),
    varchar={
        "first_name": 100, "last_name": 100, "email": 255, "gender": 20,
        "age_range": 20, "country": 100,
    },
)

PRODUCTS = Table(
    name="products",
    comment="One row per catalogue product",
    key="product_id",
    columns={
        "product_id": T.IntegerType(),
        "product_name": T.StringType(),
        "category": T.StringType(),
        "brand": T.StringType(),
        "color": T.StringType(),
        "size": T.StringType(),
        "catalog_price": PRICE,
        "cost_price": PRICE,
    },
    update_columns=(
        "product_name", "category", "brand", "color", "size", "catalog_price", "cost_price",
    ),
    stamps=("created_at", "updated_at"),
    not_null=("product_name", "catalog_price"),
    varchar={"product_name": 255, "category": 100, "brand": 100, "color": 50, "size": 50},
)

ORDERS = Table(
    name="orders",
    comment="One row per order",
    key="sale_id",
    columns={
        "sale_id": T.LongType(),
        "sale_date": T.DateType(),
        "date_id": T.IntegerType(),
        "customer_id": T.LongType(),
        "channel": T.StringType(),
        "channel_campaigns": T.StringType(),
    },
    update_columns=("sale_date", "date_id", "customer_id", "channel", "channel_campaigns"),
    stamps=("created_at", "updated_at"),
    not_null=("sale_date", "date_id", "customer_id"),
    varchar={"channel": 50, "channel_campaigns": 100},
    references={"date_id": "dim_dates", "customer_id": "customers"},
)

ORDER_ITEMS = Table(
    name="order_items",
    comment="One row per order line, the fact table",
    key="item_id",
    columns={
        "item_id": T.LongType(),
        "sale_id": T.LongType(),
        "product_id": T.IntegerType(),
        "quantity": T.IntegerType(),
        "original_price": PRICE,
        "unit_price": PRICE,
        "discount_applied": PRICE,
        "discount_percent": PERCENT,
        "discounted": T.BooleanType(),
    },
    update_columns=(
        "sale_id", "product_id", "quantity", "original_price", "unit_price",
        "discount_applied", "discount_percent", "discounted",
    ),
    stamps=("created_at",),
    generated={"item_total": PRICE},
    not_null=("sale_id", "product_id", "quantity", "original_price", "unit_price"),
    references={"sale_id": "orders", "product_id": "products"},
)

# Load order: parents before children.
TABLES: dict[str, Table] = {
    t.name: t for t in (DIM_DATES, CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)
}
