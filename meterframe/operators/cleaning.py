"""Repairs on raw rows: times, missing values, duplicates, warm-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rounding import finite
from .series import SeriesOrder, SeriesParts, over_series

# Accepted texts of a time stamp, day first where a slash or a
# dot separates the date; ISO text is never read day first.
TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy HH:mm",
    "dd.MM.yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy",
)

ZONE_SUFFIX = r"\s*(Z|UTC|[+-]\d{2}:?\d{2})$"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers (NaN, infinity) are NULL everywhere after a source was read."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[finite(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def parse_time(text: Column, formats: Sequence[str] = TIME_FORMATS) -> Column:
    """Wall-clock time of a text; a zone at its end is cut off, not applied."""
    bare = F.regexp_replace(F.trim(text), r"(?<=:\d{2})" + ZONE_SUFFIX, "")
    return F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)).cast("timestamp_ntz") for f in formats])


def unparsed_times(df: DataFrame, column: str = "timestamp") -> int:
    """Rows whose text no accepted format reads."""
    return df.where(F.col(column).isNotNull() & parse_time(F.col(column)).isNull()).count()


def timestamp_to_datetime(df: DataFrame, column: str = "timestamp", strict: bool = True) -> DataFrame:
    """Text times to TIMESTAMP_NTZ.  Strict: an unreadable text fails the job
    when its row is read; otherwise it becomes null."""
    kind = dict(df.dtypes)[column]
    if kind != "string":
        return df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    parsed = parse_time(F.col(column))
    if strict:
        failed = F.raise_error(F.concat(F.lit("unreadable time: "), F.col(column)))
        parsed = F.when(
            F.col(column).isNotNull() & parsed.isNull(), failed.cast("timestamp_ntz")
        ).otherwise(parsed)
    return df.withColumn(column, parsed)


def _first_row(columns: Sequence[str], ties: Sequence[str]) -> Column:
    """The row that comes first by ``ties``, as one mergeable aggregate: map
    tasks already reduce a group to one row, however large it is."""
    return F.min_by(F.struct(*columns), F.struct(*(ties or columns)))


def keep_first(df: DataFrame, keys: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``ties`` (must not hold nulls only)."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(_first_row(rest, ties or rest).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    )


def merge_sum(
    df: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    ties: Sequence[str],
) -> DataFrame:
    """One row per key: ``sums`` are added up (0 where all are null), any other
    column takes its first value that is not null, by ``ties``."""
    rest = [c for c in df.columns if c not in keys and c not in sums]
    order = F.struct(*(ties or rest))
    added = {c: F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums}
    taken = {c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in rest}
    return df.groupBy(*keys).agg(*added.values(), *taken.values()).select(*df.columns)


def clock_change_days(
    time: str = "timestamp", month: int = 10, first_day: int = 25, last_day: int = 30
) -> Column:
    """The days in which the hour that occurs twice is looked for."""
    return (F.month(time) == month) & F.dayofmonth(time).between(first_day, last_day)


def canonicalize_readings(
    df: DataFrame,
    key: str = "object_id",
    time: str = "timestamp",
    ties: Sequence[str] = (),
    merge_days: Column | None = None,
    sums: Sequence[str] = ("energy_import_kwh", "energy_export_kwh"),
) -> DataFrame:
    """One row per (meter, time): on ``merge_days`` duplicates are added up, on
    all others the first is kept.

    Both rules are aggregates of the same group, so one shuffle does it; no
    branch reads the input a second time.
    """
    merging = clock_change_days(time) if merge_days is None else merge_days
    rest = [c for c in df.columns if c not in (key, time)]
    order = F.struct(*(ties or rest))
    others = [c for c in rest if c not in sums]
    grouped = df.groupBy(key, time).agg(
        _first_row(rest, ties or rest).alias("__row"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(f"__sum_{c}") for c in sums],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(f"__any_{c}") for c in others],
    )

    def pick(c: str) -> Column:
        merged = F.col(f"__sum_{c}") if c in sums else F.col(f"__any_{c}")
        return F.when(merging, merged).otherwise(F.col("__row")[c]).alias(c)

    return grouped.select(*[F.col(c) if c in (key, time) else pick(c) for c in df.columns])


def handle_duplicates(df: DataFrame, dataset_type: str, key: str | None = None, ties: Sequence[str] = ()):
    """Readings: ``canonicalize_readings``.  Weather: first row per (region,
    time), whatever its data type."""
    if dataset_type == "smart_meter":
        return canonicalize_readings(df, key or "object_id", ties=ties)
    if dataset_type == "weather":
        return keep_first(df, [key or "region_id", "timestamp"], ties)
    raise ValueError("dataset_type must be 'smart_meter' or 'weather'")


def add_ingestion_time(df: DataFrame, mode: str, forecast_horizon: int | None = None) -> DataFrame:
    """``ingested_at`` is the reading's own time in a replay."""
    if mode not in ("smart_meter_backtest", "weather"):
        raise ValueError(f"unknown mode: {mode}")
    if mode == "weather" and forecast_horizon is None:
        raise ValueError("weather mode needs a forecast_horizon")
    return df.withColumn("ingested_at", F.col("timestamp"))


def drop_unkeyed(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose key columns are all there."""
    return df.na.drop(subset=list(columns) or ["object_id", "timestamp"])


def drop_warmup(
    df: DataFrame,
    n: int,
    parts: SeriesParts | None = None,
    order: SeriesOrder = SeriesOrder(),
    **measured,
) -> DataFrame:
    """Without the first n rows of each meter, and without rows of no meter."""

    def build(frame: DataFrame, p: SeriesParts) -> DataFrame:
        placed = frame.withColumn("__place", p.position())
        return placed.where(F.col("__place") >= n).drop("__place")

    keyed = df.where(F.col(order.key).isNotNull())
    return over_series(keyed, parts, build, lookback=0, order=order, **measured)


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column that has nulls; one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "nulls").where("nulls > 0")


def remove_warmup_and_validate(df: DataFrame, n: int, order: SeriesOrder = SeriesOrder()) -> DataFrame:
    """``drop_warmup``, then fail if any null is left."""
    out = drop_warmup(df, n, order=order)
    left = {r["column_name"]: r["nulls"] for r in null_counts(out).collect()}  # one row per column
    if left:
        raise ValueError(f"nulls left after warm-up removal: {left}")
    return out
