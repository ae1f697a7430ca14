"""Forecasts, scores and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterframe.operators import forecast, models, scoring, splits
from meterframe.operators.series import SeriesParts
from meterframe.plans import runs
from meterframe.plans.ledger import flatten_params, read_runs
from meterframe.session import fresh_path

from . import views
from .history_checks import IDS, KEY
from .registry import plain, query
from .views import BOUNDS, ORDER

TEST_LOW, TEST_HIGH = BOUNDS["test"]


def _range(name: str, column: str = '"timestamp"') -> str:
    low, high = BOUNDS[name]
    return f"{column} >= TIMESTAMP '{low}' AND {column} < TIMESTAMP '{high}'"


def _train(df):
    return splits.filter_time_range(df, *BOUNDS["train"])


def _test(df):
    return splits.filter_time_range(df, *BOUNDS["test"])


# Train and test without dev: the first test rows look back into train.
NAIVE = f"""
    SELECT object_id, "timestamp", energy_kwh AS y_true, y_pred, cents, pred_cents FROM (
      SELECT *, lag(energy_kwh, 24) OVER ({KEY}) AS y_pred, lag(cents, 24) OVER ({KEY}) AS pred_cents
      FROM energy WHERE ({_range("train")}) OR ({_range("test")}))
    WHERE y_pred IS NOT NULL AND ({_range("test")})"""

ERRORS = f"""
    SELECT object_id,
      CAST(sum(abs(cents - pred_cents)) AS DOUBLE) / count(*) / 100 AS "MAE",
      sqrt(CAST(sum((cents - pred_cents) * (cents - pred_cents)) AS DOUBLE) / count(*)) / 100 AS "RMSE",
      avg(CASE WHEN abs(y_true) + abs(y_pred) = 0 THEN 0
          ELSE abs(y_true - y_pred) / ((abs(y_true) + abs(y_pred)) / 2) END) AS "sMAPE"
    FROM ({NAIVE}) GROUP BY object_id"""

OVERALL = f"""
    SELECT round(avg("MAE"), 6) AS "MAE_average", round(avg("RMSE"), 6) AS "RMSE_average",
           round(avg("sMAPE"), 6) AS "sMAPE_average"
    FROM ({ERRORS})"""

# MAE and RMSE come from exact sums and are compared as they are.
PER_ID = f'SELECT object_id, "MAE", "RMSE", round("sMAPE", 6) AS "sMAPE" FROM ({ERRORS})'


def _naive(spark, sf, **options):
    df = views.energy(spark, sf)
    return forecast.seasonal_naive_forecast(_train(df), _test(df), order=ORDER, **options)


@query("seasonal_naive", f'SELECT object_id, "timestamp", y_true, y_pred FROM ({NAIVE})')
def seasonal_naive(spark, sf):
    return _naive(spark, sf)


@query(
    "errors_off_grid",
    f"""SELECT object_id, round(avg(abs(y_true - (y_pred + 0.0037::DOUBLE))), 6) AS "MAE",
      round(sqrt(avg((y_true - (y_pred + 0.0037::DOUBLE)) * (y_true - (y_pred + 0.0037::DOUBLE)))), 6) AS "RMSE"
    FROM ({NAIVE}) GROUP BY object_id""",
)
def errors_off_grid(spark, sf):
    """Predictions with more decimals than readings have."""
    moved = _naive(spark, sf).withColumn("y_pred", F.col("y_pred") + 0.0037)
    return plain(scoring.errors_per_id(moved, digits=2).drop("sMAPE"))


@query("hot_series_naive", f'SELECT object_id, "timestamp", y_true, y_pred FROM ({NAIVE})')
def hot_series_naive(spark, sf):
    return _naive(spark, sf, part_rows=25)


# History and evaluation overlap in time here (hourly series, shared hours), so
# wanted rows are those whose time occurs in the evaluation.
@query(
    "seasonal_naive_overlapping",
    """WITH train AS (SELECT * FROM series_hour WHERE object_id <> 'view'),
            test AS (SELECT * FROM series_hour WHERE object_id = 'view')
    SELECT object_id, "timestamp", energy_kwh AS y_true, y_pred FROM (
      SELECT *, lag(energy_kwh, 24) OVER (PARTITION BY object_id ORDER BY "timestamp") AS y_pred
      FROM (SELECT * FROM train UNION ALL SELECT * FROM test))
    WHERE y_pred IS NOT NULL AND "timestamp" IN (SELECT "timestamp" FROM test)""",
)
def seasonal_naive_overlapping(spark, sf):
    df = views.series_hour(spark, sf)
    return forecast.seasonal_naive_forecast(
        df.where("object_id <> 'view'"), df.where("object_id = 'view'"), order=views.HOURLY
    )


@query(
    "semi_join_time",
    """SELECT object_id, "timestamp", energy_kwh FROM series_hour
    WHERE "timestamp" IN (SELECT "timestamp" FROM series_hour WHERE object_id = 'error')""",
)
def semi_join_time(spark, sf):
    df = views.series_hour(spark, sf)
    return forecast.semi_join_time(df, df.where("object_id = 'error'")).select(
        "object_id", "timestamp", "energy_kwh"
    )


@query(
    "union_history",
    f"""SELECT {IDS}, energy_kwh FROM energy WHERE {_range("train")}
    UNION ALL SELECT {IDS}, energy_kwh FROM energy WHERE {_range("test")}""",
)
def union_history(spark, sf):
    df = views.energy(spark, sf)
    return forecast.union_history(_train(df), _test(df))


@query("mae_per_id", f'SELECT object_id, "MAE" FROM ({ERRORS})')
def mae_per_id(spark, sf):
    return _naive(spark, sf).groupBy("object_id").agg(scoring.mae("y_pred", "y_true", 2).alias("MAE"))


@query("rmse_per_id", f'SELECT object_id, "RMSE" FROM ({ERRORS})')
def rmse_per_id(spark, sf):
    return _naive(spark, sf).groupBy("object_id").agg(scoring.rmse("y_pred", "y_true", 2).alias("RMSE"))


@query("smape_per_id", f'SELECT object_id, round("sMAPE", 6) AS "sMAPE" FROM ({ERRORS})')
def smape_per_id(spark, sf):
    return plain(_naive(spark, sf).groupBy("object_id").agg(scoring.smape("y_pred", "y_true").alias("sMAPE")))


@query("evaluate_forecasts", PER_ID)
def evaluate_forecasts(spark, sf):
    _, per_id = scoring.evaluate_forecasts(_naive(spark, sf), digits=2)
    return per_id.withColumn("sMAPE", F.round("sMAPE", 6))


@query("metrics_overall", OVERALL)
def metrics_overall(spark, sf):
    return plain(scoring.evaluate_forecasts(_naive(spark, sf), digits=2)[0])


@query("naive_baseline_metrics", OVERALL)
def naive_baseline_metrics(spark, sf):
    df = views.energy(spark, sf)
    overall, _, _ = forecast.run_seasonal_naive_baseline(_train(df), _test(df), order=ORDER, digits=2)
    return plain(overall)


def _naive_run(spark, sf):
    df = views.energy(spark, sf)
    root = fresh_path(spark, "ledger")
    return root, runs.naive_run(_train(df), _test(df), root, order=ORDER, digits=2, run_id="run_20240131_000000")


@query("naive_run", PER_ID)
def naive_run(spark, sf):
    return _naive_run(spark, sf)[1].per_customer.withColumn("sMAPE", F.round("sMAPE", 6))


@query(
    "run_ledger_metrics",
    f"""SELECT 'baseline' AS category, 'seasonal_naive_per_customer' AS model,
      'run_20240131_000000' AS run_id, key, round(value, 6) AS value
    FROM (SELECT avg("MAE") AS "MAE_average", avg("RMSE") AS "RMSE_average", avg("sMAPE") AS "sMAPE_average"
          FROM ({ERRORS}))
    UNPIVOT (value FOR key IN ("MAE_average", "RMSE_average", "sMAPE_average"))""",
)
def run_ledger_metrics(spark, sf):
    root, run = _naive_run(spark, sf)
    rows = read_runs(spark, f"{root}/metrics", run_id=run.run_id)
    # Values are stored as text; compared as rounded numbers.
    return plain(rows.withColumn("value", F.col("value").cast("double")))


@query(
    "flatten_run_params",
    """WITH per AS (SELECT object_id, coalesce(tariff_code, 'none') AS t, count(*) AS n FROM readings GROUP BY ALL)
    SELECT object_id, 'counts.' || t AS param, CAST(n AS VARCHAR) AS value FROM per
    UNION ALL SELECT object_id, 'tariffs', string_agg(t, ',' ORDER BY t) FROM per GROUP BY object_id
    UNION ALL SELECT object_id, 'horizon', CAST(sum(n) AS VARCHAR) FROM per GROUP BY object_id""",
)
def flatten_run_params(spark, sf):
    per = (
        views.readings(spark, sf)
        .groupBy("object_id", F.coalesce("tariff_code", F.lit("none")).alias("t"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most one entry per event type, of which there are five.
    conf = per.groupBy("object_id").agg(
        F.map_from_entries(F.collect_list(F.struct("t", "n"))).alias("counts"),
        F.array_sort(F.collect_list("t")).alias("tariffs"),
        F.sum("n").alias("horizon"),
    )
    return flatten_params(conf, "object_id")


def _with_splits(df):
    return splits.assign_split(df, BOUNDS)


@query(
    "train_customers",
    f"""SELECT {IDS}, energy_kwh, split FROM (
      SELECT *, CASE WHEN {_range("train")} THEN 'train' WHEN {_range("dev")} THEN 'dev'
                     WHEN {_range("test")} THEN 'test' END AS split FROM energy)
    WHERE split IS NOT NULL AND object_id IN (SELECT object_id FROM energy WHERE {_range("train")})""",
)
def train_customers(spark, sf):
    df = _with_splits(views.energy(spark, sf))
    return models.train_customers(*[df.where(F.col("split") == n) for n in splits.ORDERED])


FEATURES = ["lagged_1_energy_kwh", "lagged_6_energy_kwh", "rolling_mean_energy_kwh_6", "hour_sin", "hour_cos"]


def _features(spark, sf):
    from meterframe.operators import calendar, history

    # One measure, one exchange and one sort for both kinds of feature.
    energy = views.energy(spark, sf)
    parts = SeriesParts.measure(energy, ORDER, 6)
    lagged = history.add_lags(parts.open(energy), (1, 6), parts)
    rolled = history.add_rolling_stats(lagged, (6,), ["mean"], parts)
    wanted = ["object_id", "timestamp", "event_id", "energy_kwh", "lagged_1_energy_kwh", "lagged_6_energy_kwh", "rolling_mean_energy_kwh_6"]
    return calendar.add_hours(parts.close(rolled).select(*wanted))


LINEAR = f"""
    WITH lagged AS (SELECT *, lag(energy_kwh, 1) OVER ({KEY}) AS x FROM energy),
    fitted AS (
      SELECT object_id,
        (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, sx, sy, n
      FROM (SELECT object_id, CAST(count(*) AS DOUBLE) AS n,
              CAST(sum(px) AS DOUBLE) AS sx, CAST(sum(cents) AS DOUBLE) AS sy,
              CAST(sum(px * cents) AS DOUBLE) AS sxy, CAST(sum(px * px) AS DOUBLE) AS sxx
            FROM (SELECT *, lag(cents, 1) OVER ({KEY}) AS px FROM energy)
            WHERE {_range("train")} AND px IS NOT NULL GROUP BY object_id))
    SELECT object_id, "timestamp", energy_kwh AS y_true,
      round((sy - slope * sx) / n / 100 + slope * x, 6) AS y_pred
    FROM lagged JOIN fitted USING (object_id) WHERE {_range("test")}"""


@query("per_customer_linear", LINEAR)
def per_customer_linear(spark, sf):
    from meterframe.operators import history

    df = history.add_lags(views.energy(spark, sf), (1,), order=ORDER)
    fitted = models.fit_linear(_train(df), "lagged_1_energy_kwh", "energy_kwh")
    return plain(models.predict_linear(fitted, _test(df), "lagged_1_energy_kwh", "energy_kwh"))


# With no penalty the ridge of one feature is the regression above.
@query("per_customer_ridge_unpenalised", LINEAR)
def per_customer_ridge_unpenalised(spark, sf):
    from meterframe.operators import history

    df = history.add_lags(views.energy(spark, sf), (1,), order=ORDER)
    made = models.forecast_per_customer(
        _train(df), _test(df), ["lagged_1_energy_kwh"], "energy_kwh", ORDER, penalty=0.0
    )
    return plain(made.drop("model"))


# A fitted model's numbers are unit-tested; here every evaluation row of a
# trained meter must be there with a finite prediction.
PREDICTED = f"""SELECT object_id, "timestamp", energy_kwh AS y_true, TRUE AS predicted FROM energy
    WHERE {_range("test")} AND object_id IN (SELECT object_id FROM energy WHERE {_range("train")} AND energy_kwh IS NOT NULL)"""


def _predicted(df):
    return df.select("object_id", "timestamp", "y_true", (F.abs("y_pred") < float("inf")).alias("predicted"))


@query("per_customer_model", PREDICTED)
def per_customer_model(spark, sf):
    df = _features(spark, sf)
    return _predicted(models.forecast_per_customer(_train(df), _test(df), FEATURES, "energy_kwh", ORDER))


@query("global_gbt", f"""SELECT object_id, "timestamp", energy_kwh AS y_true, TRUE AS predicted FROM energy WHERE {_range("test")}""")
def global_gbt(spark, sf):
    """A few shallow trees: that rows come through is all that is compared."""
    df = _features(spark, sf)
    fitted = models.fit_boosted_trees(_train(df), FEATURES, "energy_kwh", iterations=3, depth=4)
    return _predicted(models.predict_boosted_trees(fitted, _test(df), FEATURES, "energy_kwh", ORDER))


def _model_run(spark, sf, times=1):
    df, root = _features(spark, sf), fresh_path(spark, "ledger")
    for _ in range(times):
        run = runs.model_run(_train(df), _test(df), FEATURES, root, order=ORDER, run_id="run_20240131_000000")
    return root, run


@query("model_run", f"""SELECT object_id, TRUE AS scored FROM ({PREDICTED}) GROUP BY object_id""")
def model_run(spark, sf):
    _, run = _model_run(spark, sf)
    return run.per_customer.select("object_id", (F.col("MAE") >= 0).alias("scored"))


@query("run_ledger_rerun", f"""SELECT count(*) AS forecasts, count(DISTINCT object_id) AS meters FROM ({PREDICTED})""")
def run_ledger_rerun(spark, sf):
    """A run id written twice is one run."""
    root, _ = _model_run(spark, sf, times=2)
    return read_runs(spark, f"{root}/forecasts").agg(F.count(F.lit(1)).alias("forecasts"), F.countDistinct("object_id").alias("meters"))


@query(
    "run_ledger_params",
    """SELECT 'run_20240131_000000' AS run_id, param, value, n FROM
      (VALUES ('features', 'lagged_1_energy_kwh,lagged_6_energy_kwh,rolling_mean_energy_kwh_6,hour_sin,hour_cos'),
              ('target', 'energy_kwh'), ('ridge.penalty', '1.0')) p(param, value),
      (SELECT count(*) AS n FROM energy)""",
)
def run_ledger_params(spark, sf):
    root, run = _model_run(spark, sf)
    n = views.energy(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    return read_runs(spark, f"{root}/params", run_id=run.run_id).select("run_id", "param", "value").join(n, F.lit(True))
