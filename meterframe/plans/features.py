"""The default feature table and its splits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import calendar, encode, history, splits, weather
from ..operators.series import SeriesOrder, SeriesParts


@dataclass(frozen=True)
class FeaturePlan:
    """Windows, lags and horizon of the default table."""

    windows: tuple[int, ...] = (6, 12, 24)
    aggs: tuple[str, ...] = ("mean", "std")
    lags: tuple[int, ...] = (1, 6, 12, 24, 168)
    horizon: int = 24
    shift_hours: int = 24
    average_days: tuple[int, ...] = (30, 90)
    categories: tuple[str, ...] = ("weekday", "hour")
    data_type: str | None = "historical"
    digits: int | None = None
    part_rows: int | None = None
    downcast: str | None = None  # "float", or "half" for half precision where it fits
    order: SeriesOrder = field(default_factory=SeriesOrder)

    @property
    def lookback(self) -> int:
        """Rows before a part that its features read: a frozen value is a
        feature of the first row of its block."""
        deepest = max(max(self.windows), max(self.lags)) + self.horizon
        return max(deepest, history.averages_lookback(self.shift_hours, self.average_days))


def select_target(readings: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Time, meter and the target under its neutral name."""
    return readings.select("timestamp", "object_id", *ties, F.col("energy_import_kwh").alias("energy_kwh"))


def measure(target: DataFrame, plan: FeaturePlan) -> SeriesParts:
    return SeriesParts.measure(
        target, plan.order, plan.lookback, ["energy_kwh"], plan.digits, plan.part_rows
    )


def history_features(
    df: DataFrame, plan: FeaturePlan = FeaturePlan(), parts: SeriesParts | None = None
) -> DataFrame:
    """All features of a meter's past from one exchange and one sort."""
    parts = parts or measure(df, plan)
    opened = parts.open(df)
    rolled = history.add_rolling_stats(opened, plan.windows, plan.aggs, parts, digits=plan.digits)
    lagged = history.add_lags(rolled, plan.lags, parts)
    frozen = history.freeze_history_features(lagged, plan.horizon, (), parts)
    averaged = history.add_customer_averages(
        frozen, plan.shift_hours, plan.average_days, parts, digits=plan.digits
    )
    return parts.close(averaged)


def build_features(
    readings: DataFrame,
    metadata: DataFrame,
    weather_rows: DataFrame,
    plan: FeaturePlan = FeaturePlan(),
) -> DataFrame:
    """Readings to the model's feature table.

    History is taken from readings alone: dimension or weather rows that occur
    twice repeat finished rows and never a reading's past.  Region and weather
    follow; Spark sizes both joins when it runs.
    """
    target = select_target(readings, plan.order.ties)
    table = calendar.add_calendar_features(history_features(target, plan))
    hours = weather_rows.drop("ingested_at")
    if plan.data_type is not None:
        hours = hours.where(F.col("data_type") == plan.data_type).drop("data_type")
    table = weather.join_hours(weather.join_region(table, metadata), hours)
    table = encode.one_hot(encode.normalize_bool_columns(table), plan.categories)
    if plan.downcast:
        table = encode.downcast_floats(table, half=plan.downcast == "half")
    return table


def model_features(table: DataFrame, target: str = "energy_kwh") -> list[str]:
    """The columns of a feature table that a model may learn from: its numbers
    without the target itself, its frozen copy, ids and the region's number."""
    left_out = {target, f"{target}_frozen", "object_id", "region_id", "event_id"}
    return [f.name for f in table.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in left_out]


def make_splits(
    readings: DataFrame,
    metadata: DataFrame,
    weather_rows: DataFrame,
    bounds: splits.Bounds,
    path: str,
    plan: FeaturePlan = FeaturePlan(),
) -> str:
    """Feature table, cut by time and written as one dataset.  The cut comes
    after the history features, which read rows before a split's start."""
    table = splits.assign_split(build_features(readings, metadata, weather_rows, plan), bounds)
    return splits.write_splits(table, path, [n for n in splits.ORDERED if n in bounds])
