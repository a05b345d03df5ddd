"""Date parsing, the integer date key and the calendar attributes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, functions as F

DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")


def parse_date(value: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Text to date; a time part is dropped and text in no declared format becomes NULL."""
    return F.coalesce(*[F.try_to_date(value, fmt) for fmt in formats])


def parse_run_date(text: str) -> date:
    """The day a job runs for, given as exactly eight digits ``yyyymmdd``."""
    if not re.fullmatch(r"[0-9]{8}", text):
        raise ValueError(f"run date must be yyyymmdd, got {text!r}")
    return datetime.strptime(text, "%Y%m%d").date()


def resolve_run_dates(
    target: str | Sequence[str] | None, default: str | None = None
) -> list[date]:
    """Days to load: the requested ones if given, else the scheduler's logical day."""
    chosen = target if target else default
    if not chosen:
        raise ValueError("no run date given")
    texts = [chosen] if isinstance(chosen, str) else list(chosen)
    return sorted({parse_run_date(text) for text in texts})


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def weekend_flag(day: Column, rule: str = "sat_sun") -> Column:
    """Whether ``day`` is a weekend day; ``sunday_only`` counts Sundays alone."""
    first = {"sat_sun": 5, "sunday_only": 6}[rule]
    return F.weekday(day) >= first


def calendar_columns(day: Column, weekend_rule: str = "sat_sun") -> list[Column]:
    """The ten attributes of a date-dimension row."""
    return [
        date_key(day).alias("date_id"),
        day.alias("full_date"),
        F.year(day).cast("smallint").alias("year"),
        F.month(day).cast("smallint").alias("month"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.weekofyear(day).cast("smallint").alias("week_number"),
        F.quarter(day).cast("smallint").alias("quarter"),
        weekend_flag(day, weekend_rule).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    ]
