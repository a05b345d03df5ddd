"""From raw rows to the cleaned rows of the days to load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

from salesmart.functions.dates import DATE_FORMATS, date_key, parse_date
from salesmart.functions.values import clean_flag, clean_percent, nan_to_null, to_type
from salesmart.schemas import RAW_TYPES

# Typed before rows are grouped by them; the other columns keep their text until it was checked.
KEYS = ("item_id", "sale_id", "product_id", "customer_id")


@dataclass(frozen=True)
class CleanOptions:
    date_formats: Sequence[str] = DATE_FORMATS
    percent_mode: str = "lenient"
    missing_flag: bool = False
    weekend_rule: str = "sat_sun"


def sale_day(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> Column:
    if isinstance(df.schema["sale_date"].dataType, T.StringType):
        return parse_date(F.col("sale_date"), formats)
    return F.col("sale_date").cast("date")


def slice_days(df: DataFrame, days: Sequence[date], options: CleanOptions = CleanOptions()) -> DataFrame:
    """Rows of the given days with ``sale_date`` as a date; rows without a date match none."""
    dated = df.withColumn("sale_date", sale_day(df, options.date_formats))
    wanted = ", ".join(f"DATE '{d}'" for d in days)
    return dated.filter(f"sale_date IN ({wanted})" if days else "false")


def clean_rows(df: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Add ``date_id``, clean percent and flag, turn NaN into NULL in every float column."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    changed = {c: nan_to_null(F.col(c)) for c in floats}
    for c in KEYS:
        if df.schema[c].dataType != RAW_TYPES[c]:
            changed[c] = to_type(c, RAW_TYPES[c])
    changed["date_id"] = date_key(F.col("sale_date"))
    changed["discount_percent"] = clean_percent(F.col("discount_percent"), options.percent_mode)
    changed["discounted"] = clean_flag(F.col("discounted"), options.missing_flag)
    return df.withColumns(changed)


def load_status(counts: DataFrame, days: DataFrame) -> DataFrame:
    """One row per requested day: ``SUCCESS`` with its rows, or ``NO_DATA``."""
    return days.join(counts, "run_date", "left").select(
        "run_date",
        F.when(F.col("n_rows") > 0, "SUCCESS").otherwise("NO_DATA").alias("status"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )
