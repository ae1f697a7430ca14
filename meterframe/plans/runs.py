"""Forecast runs that end in the ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.forecast import seasonal_naive_forecast
from ..operators.boosting import TreeSettings, fit_trees, predict_trees
from ..operators.models import fit_ridge, predict_ridge
from ..operators.scoring import average_errors, errors_per_id
from ..operators.series import SeriesOrder
from .ledger import RUN_KEYS, make_run_id, metrics_as_rows, settings_as_rows, write_run


@dataclass(frozen=True)
class Run:
    """Where a run's results are, and the results as frames."""

    run_id: str
    metrics: DataFrame
    per_customer: DataFrame
    forecasts: DataFrame
    dev_metrics: DataFrame | None = None


def _score_and_save(
    spark: SparkSession,
    forecast: DataFrame,
    root: str,
    category: str,
    model: str,
    run_id: str | None,
    digits: int | None,
    key: str,
    settings: Mapping[str, object],
    dev_forecast: DataFrame | None = None,
) -> Run:
    """Forecasts are written first and scored from what was written, so the
    forecast is worked out once.  Scores of ``dev_forecast`` stand beside the
    others in the ledger, named ``dev_*``."""
    marks = dict(zip(RUN_KEYS, (category, model, run_id or make_run_id())))
    stored = spark.read.parquet(write_run(forecast, root, "forecasts", marks))
    per_customer = spark.read.parquet(
        write_run(errors_per_id(stored, key=key, digits=digits), root, "per_customer", marks)
    )
    overall = average_errors(per_customer)
    rows, dev = metrics_as_rows(overall), None
    if dev_forecast is not None:
        dev = average_errors(errors_per_id(dev_forecast, key=key, digits=digits))
        dev = dev.withColumnsRenamed({c: f"dev_{c}" for c in dev.columns})
        rows = rows.unionByName(metrics_as_rows(dev))
    write_run(rows, root, "metrics", marks)
    write_run(settings_as_rows(spark, settings), root, "params", marks)
    return Run(marks["run_id"], overall, per_customer, stored, dev)


def naive_run(
    history: DataFrame,
    evaluation: DataFrame,
    root: str,
    *,
    target: str = "energy_kwh",
    order: SeriesOrder = SeriesOrder(),
    season: int = 24,
    digits: int | None = None,
    run_id: str | None = None,
) -> Run:
    forecast = seasonal_naive_forecast(history, evaluation, target=target, order=order, season=season)
    return _score_and_save(
        history.sparkSession, forecast, root, "baseline", "seasonal_naive_per_customer", run_id, digits, order.key,
        {"season": season, "target": target, "digits": digits},
    )


def model_run(
    train: DataFrame,
    evaluation: DataFrame,
    features: Sequence[str],
    root: str,
    *,
    target: str = "energy_kwh",
    order: SeriesOrder = SeriesOrder(),
    penalty: float = 1.0,
    trees: TreeSettings | None = None,
    dev: DataFrame | None = None,
    run_id: str | None = None,
) -> Run:
    """One model per meter, scored on ``evaluation`` and, if given, on ``dev``:
    boosted trees with the settings ``trees``, else a ridge regression."""
    key = order.key
    if trees is not None:
        models, learner = fit_trees(train, features, target, key, trees), {"trees": asdict(trees)}
    else:
        models, learner = fit_ridge(train, features, target, key, penalty), {"ridge": {"penalty": penalty}}
    predict = predict_trees if trees is not None else predict_ridge

    def forecast(df: DataFrame) -> DataFrame:
        return predict(models, df, features, target, order).withColumn("model", F.lit(next(iter(learner))))

    return _score_and_save(
        train.sparkSession, forecast(evaluation), root, "model", "per_customer", run_id, None, key,
        {"features": list(features), "target": target, **learner}, None if dev is None else forecast(dev),
    )
