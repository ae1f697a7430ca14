"""Seasonal-naive forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scoring import evaluate_forecasts
from .series import GROUP_LIMIT, SeriesOrder, SeriesParts


def union_history(history: DataFrame, evaluation: DataFrame) -> DataFrame:
    """History and evaluation rows below each other, columns by name."""
    return history.unionByName(evaluation, allowMissingColumns=True)


def semi_join_time(df: DataFrame, evaluation: DataFrame, time: str = "timestamp") -> DataFrame:
    """Rows whose time occurs in the evaluation, whatever their meter.

    The number of distinct times is not bounded by anything, so the choice of
    join is left to Spark's size check; the times are made distinct before
    they travel.
    """
    return df.join(evaluation.select(time).distinct(), time, "left_semi")


def last_rows(df: DataFrame, n: int, order: SeriesOrder = SeriesOrder()) -> DataFrame:
    """The last n rows of each meter.  Map tasks keep at most n rows per
    meter, so a meter's full history is never shuffled."""
    w = Window.partitionBy(order.key).orderBy(*[F.col(c).desc() for c in order.sort])
    return df.withColumn("__back", F.row_number().over(w)).where(F.col("__back") <= n).drop("__back")


def seasonal_naive_forecast(
    history: DataFrame,
    evaluation: DataFrame,
    *,
    target: str = "energy_kwh",
    order: SeriesOrder = SeriesOrder(),
    season: int = 24,
    part_rows: int | None = None,
) -> DataFrame:
    """(key, time, y_true, y_pred): the value ``season`` rows earlier in
    history and evaluation put together, at the evaluation's times.

    Where the history ends before the evaluation starts, only the last
    ``season`` rows of each meter's history can be read, and a row is wanted
    exactly if it comes from the evaluation: the long history is cut before
    the shuffle and no join is needed.
    """
    columns = list(dict.fromkeys([order.key, *order.sort, target]))
    past = history.select(*columns, F.lit(False).alias("__wanted"))
    future = evaluation.select(*columns, F.lit(True).alias("__wanted"))
    whole = past.unionByName(future)

    time = F.col(order.time)
    span = whole.agg(
        F.max(F.when(~F.col("__wanted"), time)).alias("newest"),
        F.min(F.when(F.col("__wanted"), time)).alias("start"),
        F.max(F.when(F.col("__wanted"), time)).alias("end"),
    ).first()
    apart = span["newest"] is None or span["start"] is None or span["newest"] < span["start"]
    cut_early = apart and season <= GROUP_LIMIT

    # The few rows kept of the history come first in a meter's first part.
    parts = SeriesParts.measure(future if cut_early else whole, order, season, part_rows=part_rows)
    panel = last_rows(past, season, order).unionByName(future) if cut_early else whole
    w = parts.window()
    predicted = parts.close(parts.open(panel).select("*", F.lag(target, season).over(w).alias("y_pred")))
    kept = predicted.where(F.col("y_pred").isNotNull())
    if apart:
        kept = kept.where("__wanted")
    else:
        # Only times in the evaluation's range can match.
        inside = kept.where(time.between(span["start"], span["end"]))
        kept = semi_join_time(inside, future, order.time)
    return kept.select(order.key, order.time, F.col(target).alias("y_true"), "y_pred")


def run_seasonal_naive_baseline(
    history: DataFrame,
    evaluation: DataFrame,
    *,
    target: str = "energy_kwh",
    order: SeriesOrder = SeriesOrder(),
    season: int = 24,
    digits: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(overall, per meter, forecast)"""
    forecast = seasonal_naive_forecast(history, evaluation, target=target, order=order, season=season)
    overall, per_meter = evaluate_forecasts(forecast, "y_pred", "y_true", order.key, digits)
    return overall, per_meter, forecast
