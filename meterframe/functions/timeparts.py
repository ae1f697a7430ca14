"""Calendar columns as built-in expressions (no Python per row)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public holidays with a fixed date, as month-day.
FIXED_HOLIDAYS = {
    "lv": ("01-01", "05-01", "06-23", "06-24", "11-18", "12-24", "12-25", "12-26"),
}

# Weekend days, Monday = 0.
WEEKEND_DAYS = {"lv": (5, 6)}


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ, free of any session zone,
    so that it never runs backwards over a clock change."""
    since = time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return since.cast("interval second").cast("bigint")


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position within a period."""
    angle = position * (2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def iso_weekday(time: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(time)


def is_weekend(time: Column, country: str = "lv") -> Column:
    days = WEEKEND_DAYS.get(country, ())
    return F.weekday(time).isin(*days) if days else F.lit(False)


def is_holiday(time: Column, country: str = "lv") -> Column:
    dates = FIXED_HOLIDAYS.get(country, ())
    month_day = F.month(time) * 100 + F.dayofmonth(time)
    wanted = [int(d[:2]) * 100 + int(d[3:]) for d in dates]
    return month_day.isin(*wanted) if wanted else F.lit(False)
