import numpy as np
import pandas as pd
import pytest
from conftest import in_order
from pyspark.sql import functions as F

from meterframe.operators import forecast, models, scoring
from meterframe.operators.series import SeriesOrder
from meterframe.plans import runs
from meterframe.plans.ledger import make_run_id, read_runs, settings_as_rows


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(
        [("A", 10.0, 11.0), ("A", 20.0, 19.0), ("B", 10.0, 12.0), ("B", 20.0, 18.0)],
        "object_id string, y_true double, y_pred double",
    )


@pytest.mark.parametrize("digits", [None, 2])
def test_errors(scored, digits):
    overall, per_id = scoring.evaluate_forecasts(scored, digits=digits)
    found = {r["object_id"]: (r["MAE"], r["RMSE"]) for r in per_id.collect()}
    assert found == {"A": (1.0, 1.0), "B": (2.0, 2.0)}
    assert (overall.first()["MAE_average"], overall.first()["RMSE_average"]) == (1.5, 1.5)


def test_overall_is_a_mean_over_ids(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 2.0)] + [("B", 1.0, 4.0)] * 9 + [("C", 1.0, None)],
        "object_id string, y_true double, y_pred double",
    )
    overall, per_id = scoring.evaluate_forecasts(df)
    assert overall.first()["MAE_average"] == 2.0
    assert per_id.where("object_id = 'C'").first()["MAE"] is None


def test_smape(spark):
    df = spark.createDataFrame(
        [("zero", 0.0, 0.0), ("opposite", 1.0, -1.0), ("half", 1.0, 3.0), ("gap", 1.0, 1.0), ("gap", None, 2.0)],
        "object_id string, y_true double, y_pred double",
    )
    found = {r["object_id"]: r["sMAPE"] for r in scoring.errors_per_id(df).collect()}
    assert found == {"zero": 0.0, "opposite": 2.0, "half": 1.0, "gap": 0.0}


def test_metrics_are_partial_aggregates(scored):
    plan = scoring.errors_per_id(scored)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan


def brute(past, future, season):
    """(meter, hour, true, predicted) by the definition."""
    times = {h for _, h, _ in future}
    out = []
    for meter in sorted({m for m, _, _ in past + future}):
        rows = sorted((h, v) for m, h, v in past + future if m == meter)
        for i, (h, v) in enumerate(rows):
            if i >= season and h in times and rows[i - season][1] is not None:
                out.append((meter, h, v, rows[i - season][1]))
    return out


@pytest.mark.parametrize("part_rows", [None, 9])
@pytest.mark.parametrize("late", [0, 50])
def test_seasonal_naive(panel, part_rows, late):
    """Evaluation after the history (late) and at the same hours, other meters."""
    past = [("a", h, float(h)) for h in range(40)] + [("b", h, None if h == 37 else h + 0.5) for h in range(35, 40)]
    meter = "a" if late else "c"
    future = [(meter, h + late, 100.0 + h) for h in range(30)] + [("b", late + 10 + h, 7.0) for h in range(30, 40)]
    out = forecast.seasonal_naive_forecast(panel(past), panel(future), season=5, part_rows=part_rows)
    hours = out.withColumn("h", F.expr("cast(cast(timestamp - timestamp_ntz'2020-01-01 00:00:00' as interval hour) as int)"))
    assert in_order(hours, "object_id", "h", "y_true", "y_pred") == brute(past, future, 5)


def test_long_history_is_cut_before_the_shuffle(panel):
    out = forecast.seasonal_naive_forecast(
        panel([("a", h, 1.0) for h in range(50)]), panel([("a", h, 1.0) for h in range(60, 70)]), season=3
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Join" not in plan


def test_naive_without_history(panel):
    empty = panel([("a", 0, 1.0)]).where("false")
    out = forecast.seasonal_naive_forecast(empty, panel([("a", h, float(h)) for h in range(4)]), season=2)
    assert in_order(out, "y_pred") == [(0.0,), (1.0,)]


@pytest.fixture
def learnable(spark):
    rng = np.random.default_rng(7)
    frames = []
    for meter, (a, b, c) in {"m": (1.0, 2.0, -3.0), "n": (0.0, 0.5, 4.0)}.items():
        x = rng.normal(size=(300, 2)) * [1.0, 10.0] + [5.0, -100.0]
        frames.append(
            pd.DataFrame(
                {
                    "object_id": meter,
                    "timestamp": pd.date_range("2020-01-01", periods=300, freq="h"),
                    "x": x[:, 0],
                    "z": x[:, 1],
                    "flat": 1.0,
                    "energy_kwh": a + b * x[:, 0] + c * x[:, 1],
                }
            )
        )
    df = spark.createDataFrame(pd.concat(frames)).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return df.repartition(7)


FEATURES = ["x", "z", "flat"]


def test_ridge_finds_the_weights(learnable):
    found = {r["object_id"]: r for r in models.fit_ridge(learnable, FEATURES, "energy_kwh", penalty=0.0).collect()}
    assert found["m"]["weights"] == pytest.approx([2.0, -3.0, 0.0], abs=1e-6)
    assert found["n"]["intercept"] == pytest.approx(0.0, abs=1e-4)
    assert found["m"]["rows"] == 300


def test_ridge_of_one_meter_spread_over_tasks(learnable, spark):
    """The same weights however the rows are spread."""
    one = models.fit_ridge(learnable.coalesce(1), FEATURES, "energy_kwh").orderBy("object_id").collect()
    many = models.fit_ridge(learnable.repartition(50), FEATURES, "energy_kwh").orderBy("object_id").collect()
    for a, b in zip(one, many):
        assert a["weights"] == pytest.approx(b["weights"], rel=1e-9)
    small_batches = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(small_batches)
    spark.conf.set(small_batches, "17")
    try:
        tiny = models.fit_ridge(learnable, FEATURES, "energy_kwh").orderBy("object_id").collect()
    finally:
        spark.conf.set(small_batches, before)
    for a, b in zip(one, tiny):
        assert a["weights"] == pytest.approx(b["weights"], rel=1e-9)


def test_prediction_covers_missing_features(learnable):
    gap = learnable.withColumn("x", F.when(F.hour("timestamp") > 0, F.col("x")))
    out = models.forecast_per_customer(learnable, gap, FEATURES, "energy_kwh")
    assert out.count() == 600 and out.where("y_pred is null").count() == 0


def test_only_trained_meters_are_predicted(learnable):
    out = models.forecast_per_customer(learnable.where("object_id = 'm'"), learnable, FEATURES, "energy_kwh")
    assert [r[0] for r in out.select("object_id").distinct().collect()] == ["m"]


def test_a_meter_that_never_has_a_feature_is_kept(learnable):
    """Meter n has no x at all: its other features still give a model."""
    gap = learnable.withColumn("x", F.when(F.col("object_id") != "n", F.col("x")))
    out = models.forecast_per_customer(gap, gap, FEATURES, "energy_kwh")
    assert out.count() == learnable.count() and out.where("y_pred is null").count() == 0


def test_features_far_from_zero(spark):
    rows = [("a", h, 1e9 + h, 2.0 * h) for h in range(7)]
    df = spark.createDataFrame(rows, "object_id string, h int, x double, energy_kwh double").withColumn(
        "timestamp", F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, h)")
    )
    fitted = models.fit_ridge(df, ["x"], "energy_kwh", penalty=0.0).first()
    assert fitted["weights"][0] == pytest.approx(2.0) and fitted["rows"] == 7


def test_rows_with_missing_features_are_learned_from(spark):
    rows = [("a", h, float(h) if h < 5 else None, 3.0 * h if h < 5 else 100.0) for h in range(10)]
    df = spark.createDataFrame(rows, "object_id string, h int, x double, energy_kwh double")
    fitted = models.fit_ridge(df, ["x"], "energy_kwh", penalty=0.0).first()
    # the missing x stand at the mean, 2: by least squares over all ten rows
    x = [0, 1, 2, 3, 4] + [2] * 5
    y = [0, 3, 6, 9, 12] + [100] * 5
    slope = sum((a - 2) * (b - sum(y) / 10) for a, b in zip(x, y)) / sum((a - 2) ** 2 for a in x)
    assert fitted["weights"][0] == pytest.approx(slope) and fitted["rows"] == 10


def test_boosted_trees(learnable):
    gap = learnable.withColumn("x", F.when(F.hour("timestamp") > 0, F.col("x")))
    fitted = models.fit_boosted_trees(gap, FEATURES, "energy_kwh", iterations=2, depth=2, min_rows=5)
    out = models.predict_boosted_trees(fitted, gap, FEATURES, "energy_kwh")
    assert out.columns == ["object_id", "timestamp", "y_true", "y_pred"]
    assert out.where("y_pred is null").count() == 0


def test_run_ids_and_settings(spark):
    from datetime import datetime

    assert make_run_id(datetime(2024, 5, 6, 7, 8, 9)) == "run_20240506_070809"
    rows = settings_as_rows(spark, {"a": 1, "f": ["x", "y"], "p": {"rate": 0.1}, "none": None}).collect()
    assert {r["param"]: r["value"] for r in rows} == {"a": "1", "f": "x,y", "p.rate": "0.1", "none": None}


def test_predictions_are_not_rounded(spark):
    df = spark.createDataFrame([("a", 1.0, 1.004)], "object_id string, y_true double, y_pred double")
    row = scoring.errors_per_id(df, digits=2).first()
    assert row["MAE"] == pytest.approx(0.004) and row["RMSE"] == pytest.approx(0.004)


def test_naive_run_is_kept(panel, spark, tmp_path):
    past = panel([("a", h, float(h)) for h in range(10)])
    future = panel([("a", h, float(h)) for h in range(10, 20)])
    root = str(tmp_path / "runs")
    for run_id in ("run_1", "run_2", "run_2"):
        run = runs.naive_run(past, future, root, season=2, run_id=run_id)
        assert run.metrics.first()["MAE_average"] == 2.0
    kept = read_runs(spark, f"{root}/metrics", run_id="run_2")
    assert {r["key"]: r["value"] for r in kept.collect()}["MAE_average"] == "2.0"
    assert read_runs(spark, f"{root}/forecasts", model="seasonal_naive_per_customer").count() == 20
    assert set(kept.columns) == {"key", "value", "category", "model", "run_id"}


def test_other_key_and_time_names(panel):
    df = panel([("a", h, float(h)) for h in range(6)]).withColumnsRenamed({"object_id": "meter", "timestamp": "at"})
    out = forecast.seasonal_naive_forecast(
        df.where("energy_kwh < 3"), df.where("energy_kwh >= 3"), order=SeriesOrder("meter", "at"), season=3
    )
    assert sorted((r["y_true"], r["y_pred"]) for r in out.collect()) == [(3.0, 0.0), (4.0, 1.0), (5.0, 2.0)]


def test_a_small_meter_gives_one_matrix(spark, monkeypatch):
    """Matrices are wider than rows; meters of few rows are not dealt to many of them."""
    made, products = spark.sparkContext.accumulator(0), models._products

    def counted(key):
        run = products(key)

        def counting(batches):
            for frame in run(batches):
                made.add(len(frame))
                yield frame

        return counting

    monkeypatch.setattr(models, "_products", counted)
    rows = spark.range(300 * 12).selectExpr("concat('m', id % 300) AS object_id", "sin(id) AS a", "2 * sin(id) + 1 AS energy_kwh").repartition(7)
    found = models.fit_ridge(rows, ["a"], "energy_kwh", penalty=0.0).collect()
    assert len(found) == 300 and all(r["weights"] == pytest.approx([2.0], abs=1e-9) and r["rows"] == 12 for r in found)
    assert made.value == 300


def test_large_and_small_meters_together(spark):
    """Rows of meters with a large share stay where they are, others move."""
    rows = spark.range(9000).selectExpr(
        "CASE WHEN id < 4000 THEN 'big' WHEN id < 8990 THEN concat('m', id % 500) END AS object_id", "sin(id) AS a", "IF(id % 50 = 7, NULL, 3 * sin(id) - 2) AS energy_kwh"
    )
    found = {r["object_id"]: r for r in models.fit_ridge(rows.repartition(5), ["a"], "energy_kwh", penalty=0.0).collect()}
    known = {r[0]: r[1] for r in rows.where("object_id IS NOT NULL AND energy_kwh IS NOT NULL").groupBy("object_id").count().collect()}
    assert {k: r["rows"] for k, r in found.items()} == known and len(known) > 256
    assert all(r["weights"] == pytest.approx([3.0], abs=1e-9) for r in found.values())
