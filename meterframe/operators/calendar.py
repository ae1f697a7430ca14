"""Calendar features of ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeparts


def add_hours(df: DataFrame, time: str = "timestamp") -> DataFrame:
    hour = F.hour(time)
    sin, cos = timeparts.cycle(hour, 24)
    return df.select("*", hour.alias("hour"), sin.alias("hour_sin"), cos.alias("hour_cos"))


def add_dates(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.withColumn("day", F.dayofmonth(time))


def add_weekdays(df: DataFrame, weekends: bool = False, country: str = "lv", time: str = "timestamp") -> DataFrame:
    out = df.withColumn("weekday", timeparts.iso_weekday(F.col(time)))
    return out.withColumn("is_weekend", timeparts.is_weekend(F.col(time), country)) if weekends else out


def add_weeks(df: DataFrame, time: str = "timestamp") -> DataFrame:
    week = F.weekofyear(time)
    sin, cos = timeparts.cycle(week, 52)
    return df.select("*", week.alias("week"), sin.alias("week_sin"), cos.alias("week_cos"))


def add_months(df: DataFrame, time: str = "timestamp") -> DataFrame:
    month = F.month(time)
    sin, cos = timeparts.cycle(month, 12)
    return df.select("*", month.alias("month"), sin.alias("month_sin"), cos.alias("month_cos"))


def add_holidays(df: DataFrame, country: str = "lv", time: str = "timestamp") -> DataFrame:
    return df.withColumn("is_holiday", timeparts.is_holiday(F.col(time), country))


def add_calendar_features(df: DataFrame, *, country: str = "lv", time: str = "timestamp", **switches: bool) -> DataFrame:
    """All calendar columns in one projection.  A group of columns is left out
    by its name: ``hours=False``, ``weekends=False`` and so on."""
    moment = F.col(time)

    def with_cycle(name: str, value, length: int) -> dict:
        sin, cos = timeparts.cycle(value, length)
        return {name: value, f"{name}_sin": sin, f"{name}_cos": cos}

    groups = {
        "hours": with_cycle("hour", F.hour(moment), 24),
        "dates": {"day": F.dayofmonth(moment)},
        "weekdays": {"weekday": timeparts.iso_weekday(moment)},
        "weekends": {"is_weekend": timeparts.is_weekend(moment, country)},
        "holidays": {"is_holiday": timeparts.is_holiday(moment, country)},
        "weeks": with_cycle("week", F.weekofyear(moment), 52),
        "months": with_cycle("month", F.month(moment), 12),
    }
    unknown = switches.keys() - groups.keys()
    if unknown:
        raise TypeError(f"no such calendar columns: {sorted(unknown)}")
    off = {name for name, on in switches.items() if not on}
    if "weekdays" in off:
        off.add("weekends")
    wanted = [c.alias(name) for group, columns in groups.items() if group not in off for name, c in columns.items()]
    return df.select("*", *wanted)
