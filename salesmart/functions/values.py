"""Cleaning of percentages, flags, numbers and missing values, and derived item columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: what counts as a number once every percent sign is gone. The guard keeps out
# text that a cast would take (suffixes such as 1d, NaN, infinities).
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Field texts of a CSV file that mean "missing" to the usual dataframe readers.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_to_null(value: Column) -> Column:
    return F.when(~value.isin(*MISSING_TOKENS), value)


def nan_to_null(value: Column) -> Column:
    """NULL for a float NaN, the value otherwise."""
    return F.when(~F.isnan(value), value)


def number_or_null(text: Column) -> Column:
    """Text to double; anything that is not plainly a number becomes NULL."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def percent_or_null(text: Column) -> Column:
    """``'15.50%'`` to 15.5; NULL where the text is missing or is no number."""
    return number_or_null(F.replace(text.cast("string"), F.lit("%"), F.lit("")))


def clean_percent(text: Column, mode: str = "lenient") -> Column:
    """Percent text to double. ``lenient`` turns missing and bad text into 0, ``strict`` raises."""
    parsed = percent_or_null(text)
    if mode == "lenient":
        return F.coalesce(parsed, F.lit(0.0))
    if mode == "strict":
        shown = F.coalesce(text.cast("string"), F.lit("missing"))
        return F.when(
            percent_is_bad(text),
            F.raise_error(F.concat(F.lit("not a percentage: "), shown)).cast("double"),
        ).otherwise(parsed)
    raise ValueError(f"unknown percent mode {mode!r}")


def percent_is_bad(text: Column) -> Column:
    """True for what the strict mode refuses: missing text and text that is no percentage."""
    return percent_or_null(text).isNull()


def flag_or_null(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(text.try_cast("boolean"), number_or_null(text) != 0)


def clean_flag(value: Column, null_as: bool = False) -> Column:
    """Truthiness: booleans as they are, numbers by being non-zero, else ``null_as``."""
    return F.coalesce(flag_or_null(value), F.lit(null_as))


def whole_number_sql(column: str, dtype: T.DataType) -> str:
    """SQL for a column as an integer type: ``3.0`` is taken, ``3.5`` is not."""
    name = dtype.simpleString()
    wide = f"try_cast({column} AS decimal(38,6))"
    fraction = f"CASE WHEN {wide} = floor({wide}) THEN try_cast({wide} AS {name}) END"
    return f"coalesce(try_cast(CAST({column} AS string) AS {name}), {fraction})"


def to_type(column: str, dtype: T.DataType) -> Column:
    """A column coerced to a type of the mart; NULL where a value does not fit.

    Decimals round half away from zero to their scale.
    """
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)):
        return F.expr(whole_number_sql(column, dtype)).alias(column)
    return F.col(column).try_cast(dtype).alias(column)


def item_total(quantity: Column, unit_price: Column) -> Column:
    """Generated column of an order line; NULL where the product leaves the type."""
    return (quantity * unit_price).try_cast("decimal(12,2)")


def sale_product_key(sale_id: Column, product_id: Column) -> Column:
    """``<sale>_<product>``; NULL if either part is, as with the SQL concatenation operator."""
    return F.concat(sale_id.cast("string"), F.lit("_"), product_id.cast("string"))
