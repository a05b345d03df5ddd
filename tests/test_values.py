"""Column expressions against hand-written expectations."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salesmart.functions.dates import (
    calendar_columns, date_key, parse_date, parse_run_date, resolve_run_dates, weekend_flag,
)
from salesmart.functions.values import (
    clean_flag, clean_percent, item_total, missing_to_null, nan_to_null, percent_is_bad,
    sale_product_key, to_type,
)
from salesmart.schemas import PERCENT, PRICE
from pyspark.sql import types as T


def apply(spark, values, dtype, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_lenient_percent(spark):
    good = {"15.50%": 15.5, " 15 ": 15.0, "15 %": 15.0, "1e1": 10.0, "-5%": -5.0, "10%%": 10.0}
    bad = ["15,5", "", "nan", "1_0", "%", "0x1F", "1d", "None", None, "inf"]
    got = apply(spark, [*good, *bad], "string", clean_percent(F.col("v")))
    assert got == [*good.values(), *[0.0] * len(bad)]


def test_strict_percent(spark):
    assert apply(spark, ["15%"], "string", clean_percent(F.col("v"), "strict")) == [15.0]
    for value in ("n/a", None):
        with pytest.raises(PySparkException, match="not a percentage"):
            apply(spark, ["15%", value], "string", clean_percent(F.col("v"), "strict"))
    assert apply(spark, ["15%", "n/a", None], "string", percent_is_bad(F.col("v"))) == [False, True, True]


def test_parse_date(spark):
    day = date(2025, 6, 16)
    texts = ["2025-06-16", "2025-06-16 10:00:00", "bad", "16/06/2025", "", "2025-13-01", None]
    assert apply(spark, texts, "string", parse_date(F.col("v"))) == [day, day, *[None] * 5]
    assert apply(spark, texts[3:4], "string", parse_date(F.col("v"), ["dd/MM/yyyy"])) == [day]


def test_run_dates():
    assert parse_run_date("20250616") == date(2025, 6, 16)
    for text in ("2025-06-16", "202506", "2025616", "20251301", ""):
        with pytest.raises(ValueError):
            parse_run_date(text)
    assert resolve_run_dates(None, "20250616") == [date(2025, 6, 16)]
    assert resolve_run_dates("20250615", "20250616") == [date(2025, 6, 15)]
    assert resolve_run_dates(["20250617", "20250615"]) == [date(2025, 6, 15), date(2025, 6, 17)]
    with pytest.raises(ValueError):
        resolve_run_dates(None)


def test_flags(spark):
    texts = ["True", "False", None, "0", "2", "junk"]
    assert apply(spark, texts, "string", clean_flag(F.col("v"))) == [True, False, False, False, True, False]
    assert apply(spark, [None], "string", clean_flag(F.col("v"), null_as=True)) == [True]
    assert apply(spark, [0, 2, None], "int", clean_flag(F.col("v"))) == [False, True, False]
    assert apply(spark, [True, False], "boolean", clean_flag(F.col("v"))) == [True, False]


def test_missing(spark):
    assert apply(spark, ["", "NA", "n/a", "x", None], "string", missing_to_null(F.col("v"))) == [
        None, None, None, "x", None,
    ]
    assert apply(spark, [float("nan"), 1.0, None], "double", nan_to_null(F.col("v"))) == [None, 1.0, None]


def test_coercion(spark):
    assert apply(spark, ["1.005", "-1.005", "12345678901.00", "x", None], "string", to_type("v", PRICE)) == [
        Decimal("1.01"), Decimal("-1.01"), None, None, None,
    ]
    assert apply(spark, [15.5, 1500.0], "double", to_type("v", PERCENT)) == [Decimal("15.50"), None]
    assert apply(spark, ["3", "3.0", "3.5", "x", "99999999999"], "string", to_type("v", T.IntegerType())) == [
        3, 3, None, None, None,
    ]


def test_item_total_and_key(spark):
    df = spark.createDataFrame([(2, Decimal("3.50")), (2_000_000_000, Decimal("9999999999.00"))], "q int, p decimal(12,2)")
    assert [r.x for r in df.select(item_total(F.col("q"), F.col("p")).alias("x")).collect()] == [Decimal("7.00"), None]
    keys = spark.createDataFrame([(7, 3), (7, None)], "s long, p int")
    assert [r.x for r in keys.select(sale_product_key(F.col("s"), F.col("p")).alias("x")).collect()] == ["7_3", None]


@pytest.mark.parametrize(
    "day, key, name, week, quarter, weekend",
    [
        (date(2025, 6, 13), 20250613, "Friday", 24, 2, False),
        (date(2025, 6, 14), 20250614, "Saturday", 24, 2, True),
        (date(2025, 6, 15), 20250615, "Sunday", 24, 2, True),
        (date(2024, 12, 30), 20241230, "Monday", 1, 4, False),
        (date(2021, 1, 3), 20210103, "Sunday", 53, 1, True),
    ],
)
def test_calendar(spark, day, key, name, week, quarter, weekend):
    df = spark.createDataFrame([(day,)], "d date")
    row = df.select(*calendar_columns(F.col("d"))).first()
    assert (row.date_id, row.day_of_week, row.week_number, row.quarter) == (key, name, week, quarter)
    assert row.is_weekend is weekend and row.is_holiday is False
    assert df.select(date_key(F.col("d"))).first()[0] == key
    assert df.select(weekend_flag(F.col("d"), "sunday_only")).first()[0] is (name == "Sunday")
