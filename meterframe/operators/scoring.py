"""Forecast errors per meter and over meters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import from_units


def _error(pred: str, actual: str, digits: int | None) -> Column:
    """Absolute error; with ``digits`` in units of that decimal.  An error
    within rounding of a whole number of units is that number, so sums over
    values with so many decimals are exact; others stay as they are."""
    error = F.abs(F.col(actual) - F.col(pred))
    if digits is None:
        return error
    scaled = error * F.lit(10.0**digits)
    return F.when(F.abs(scaled - F.rint(scaled)) < 1e-6, F.rint(scaled)).otherwise(scaled)


def mae(pred: str, actual: str, digits: int | None = None) -> Column:
    """Mean absolute error.  ``digits`` says how many decimals values usually
    have; predictions are not rounded to them."""
    error = _error(pred, actual, digits)
    if digits is None:
        return F.avg(error)
    return from_units(F.sum(error) / F.count(error), digits)


def rmse(pred: str, actual: str, digits: int | None = None) -> Column:
    """Root of the mean squared error."""
    error = _error(pred, actual, digits)
    if digits is None:
        return F.sqrt(F.avg(error * error))
    return from_units(F.sqrt(F.sum(error * error) / F.count(error)), digits)


def smape(pred: str, actual: str) -> Column:
    """Symmetric relative error, 0 to 2; 0 where both values are 0."""
    scale = (F.abs(F.col(actual)) + F.abs(F.col(pred))) / 2
    return F.avg(F.when(scale == 0, F.lit(0.0)).otherwise(F.abs(F.col(actual) - F.col(pred)) / scale))


def errors_per_id(
    df: DataFrame, pred: str = "y_pred", actual: str = "y_true", key: str = "object_id", digits: int | None = None
) -> DataFrame:
    """MAE, RMSE and sMAPE of each id in one aggregate.  Map tasks send one
    row per id, so the size of an id does not matter."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        mae(pred, actual, digits).alias("MAE"),
        rmse(pred, actual, digits).alias("RMSE"),
        smape(pred, actual).alias("sMAPE"),
    )


def average_errors(per_id: DataFrame) -> DataFrame:
    """One row: each metric's unweighted mean over ids."""
    return per_id.agg(*[F.avg(m).alias(f"{m}_average") for m in ("MAE", "RMSE", "sMAPE")])


def evaluate_forecasts(
    df: DataFrame, pred: str = "y_pred", actual: str = "y_true", key: str = "object_id", digits: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(overall, per id)"""
    per_id = errors_per_id(df, pred, actual, key, digits)
    return average_errors(per_id), per_id
