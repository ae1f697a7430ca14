"""One model per meter, fitted where the data is.

The model is a ridge regression.  It needs only sums of products per meter,
which are put together from partial sums, so a meter of any size is spread over
many tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import finite
from ..joins import apart
from ..session import durable
from .series import SeriesOrder

# The functions below travel to the tasks with their code, so that executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 64  # of a moving fit (operators.moving)


def train_customers(train: DataFrame, *others: DataFrame, key: str = "object_id") -> DataFrame:
    """All frames below each other, restricted to meters that have training
    rows.  Frames carry their own ``split`` column."""
    whole = reduce(lambda a, b: a.unionByName(b), others, train)
    return whole.join(train.select(key).distinct(), key, "left_semi")


# -- one feature, closed form -------------------------------------------------


def fit_linear(train: DataFrame, feature: str, target: str, key: str = "object_id") -> DataFrame:
    """(key, slope, intercept) by least squares."""
    return train.groupBy(key).agg(
        F.regr_slope(F.col(target), F.col(feature)).alias("slope"),
        F.regr_intercept(F.col(target), F.col(feature)).alias("intercept"),
    )


def predict_linear(
    models: DataFrame, df: DataFrame, feature: str, target: str, order: SeriesOrder = SeriesOrder()
) -> DataFrame:
    return df.join(models, order.key, "inner").select(
        order.key,
        order.time,
        F.col(target).alias("y_true"),
        (F.col("intercept") + F.col("slope") * F.col(feature)).alias("y_pred"),
    )


# -- many features, sums of products ------------------------------------------
#
# A meter's rows [x, y], centred on the meter's means, enter the fit only through
# the matrix of their sums of products, of which the upper triangle is kept.


def _runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def _products(key: str):
    """Sums of products per key over rows sorted by key: one open matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, None
        for batch in batches:
            if batch.empty:
                continue
            keys, values = batch[key].to_numpy(), np.stack(batch["centred"].to_list())
            upper = np.triu_indices(values.shape[1])
            starts = _runs(keys)
            out_keys, out = [], []
            for start, block in zip(starts, np.split(values, starts[1:])):
                if held is not None and keys[start] != held_key:
                    out_keys.append(held_key)
                    out.append(held)
                    held = None
                mine = (block.T @ block)[upper]
                held_key, held = keys[start], mine if held is None else held + mine
            if out:
                yield pd.DataFrame({key: out_keys, "products": out})
        if held is not None:
            yield pd.DataFrame({key: [held_key], "products": [held]})

    return run


def _added_up(key: str):
    """One row per key from rows sorted by key, one open key at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, None
        for batch in batches:
            if batch.empty:
                continue
            keys = batch[key].to_numpy()
            starts = _runs(keys)
            sums = np.add.reduceat(np.stack(batch["products"].to_list()), starts, axis=0)
            found = list(keys[starts])
            if held is not None:
                if found[0] == held_key:
                    sums[0] += held
                else:
                    found, sums = [held_key, *found], np.vstack([held, sums])
            held_key, held = found[-1], sums[-1]
            if len(found) > 1:
                yield pd.DataFrame({key: found[:-1], "products": list(sums[:-1])})
        if held is not None:
            yield pd.DataFrame({key: [held_key], "products": [held]})

    return run


def _solve(products: np.ndarray, n: int, size: int, means: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights on standardised features from sums of centred products."""
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = products
    spread = (full + np.triu(full, 1).T) / n
    scale = np.sqrt(np.clip(np.diag(spread)[:-1], 0.0, None))
    # A feature that does not vary at this meter, beyond rounding, takes no part.
    used = np.flatnonzero(scale > 1e-13 * (1.0 + np.abs(means)))
    weights = np.zeros(len(scale))
    if len(used):
        s = scale[used]
        corr = spread[np.ix_(used, used)] / np.outer(s, s)
        load = spread[used, -1] / s
        weights[used] = np.linalg.lstsq(corr + penalty / n * np.eye(len(s)), load, rcond=1e-10)[0] / s
    return weights


def fit_ridge(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    key: str = "object_id",
    penalty: float = 1.0,
) -> DataFrame:
    """(key, rows, intercept, level, weights, means), one row per meter with a
    target; the level is the target's mean.

    All rows with a target take part.  A missing feature stands at the meter's
    mean; one that a meter never has gets no weight there.  Rows are centred on
    the meter's means first, so large values do not cancel.  They are shuffled
    once, by meter, and give one matrix a meter there.  Rows of the few meters
    that hold a large share stay where they are; only their matrices meet.
    """
    columns = [*features, target]
    kind = dict(train.dtypes)[key]
    rows = train.select(key, *[finite(F.col(c).cast("double")).alias(f"__{i}") for i, c in enumerate(columns)])
    rows = rows.where(F.col(f"__{len(features)}").isNotNull() & F.col(key).isNotNull())
    centres = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.array(*[F.avg(f"__{i}") for i in range(len(columns))]).alias("centres")
    )
    centres = durable(centres, "centres")
    centred = F.array(*[F.coalesce(F.col(f"__{i}") - F.col("centres")[i], F.lit(0.0)) for i in range(len(columns))])
    sums = f"{key} {kind}, products array<double>"

    def products(joined: DataFrame) -> DataFrame:
        return joined.select(key, centred.alias("centred")).sortWithinPartitions(key).mapInPandas(_products(key), sums)

    of_heavy, heavy, of_light, light = apart(rows, centres, [key], "rows")
    by_key = products(of_light.repartition(key).join(light, key))
    if heavy is not None:
        parts = products(of_heavy.join(F.broadcast(heavy), key))
        by_key = by_key.unionByName(parts.repartition(key).sortWithinPartitions(key).mapInPandas(_added_up(key), sums))

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            means = [np.array(c, float)[:-1] for c in batch["centres"]]
            made = [_solve(p, n, len(columns), np.nan_to_num(m), penalty) for p, n, m in zip(batch["products"], batch["rows"], means)]
            yield pd.DataFrame(
                {
                    key: batch[key],
                    "rows": batch["rows"],
                    "intercept": [float(c[-1] - w @ np.nan_to_num(m)) for c, w, m in zip(batch["centres"], made, means)],
                    "level": [float(c[-1]) for c in batch["centres"]],
                    "weights": made,
                    "means": [[None if np.isnan(x) else x for x in m] for m in means],
                }
            )

    return by_key.join(centres, key).mapInPandas(
        solved, f"{key} {kind}, rows bigint, intercept double, level double, weights array<double>, means array<double>"
    )


def predict_ridge(
    models: DataFrame,
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order: SeriesOrder = SeriesOrder(),
) -> DataFrame:
    """Predictions as plain column arithmetic for every row of a fitted meter; a
    missing feature takes the meter's training mean."""
    terms: list[Column] = [
        F.coalesce((finite(F.col(c).cast("double")) - F.col("means")[i]) * F.col("weights")[i], F.lit(0.0))
        for i, c in enumerate(features)
    ]
    score = reduce(lambda a, b: a + b, terms, F.col("level"))
    return df.join(models.drop("rows"), order.key, "inner").select(
        order.key, order.time, F.col(target).alias("y_true"), score.alias("y_pred")
    )


def forecast_per_customer(
    train: DataFrame,
    evaluation: DataFrame,
    features: Sequence[str],
    target: str,
    order: SeriesOrder = SeriesOrder(),
    penalty: float = 1.0,
) -> DataFrame:
    """(key, time, y_true, y_pred, model) for all evaluation rows of meters that
    have training rows with a target."""
    models = fit_ridge(train, features, target, order.key, penalty)
    return predict_ridge(models, evaluation, features, target, order).withColumn("model", F.lit("ridge"))


# -- boosted trees over all meters --------------------------------------------


def fit_boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    iterations: int = 400,
    step: float = 0.05,
    depth: int = 12,
    min_rows: int = 50,
    seed: int = 42,
):
    """Spark ML boosted trees over all meters; missing features take the
    training mean.  The trees grow from distributed histograms."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    filled = [f"__filled_{c}" for c in features]
    pipeline = Pipeline(
        stages=[
            Imputer(inputCols=list(features), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="__vector"),
            GBTRegressor(
                featuresCol="__vector",
                labelCol=target,
                predictionCol="y_pred",
                maxIter=iterations,
                stepSize=step,
                maxDepth=depth,
                minInstancesPerNode=min_rows,
                seed=seed,
                maxMemoryInMB=1024,
            ),
        ]
    )
    return pipeline.fit(_doubles(train, features, target).where(F.col(target).isNotNull()))


def _doubles(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    wanted = {*features, target}
    return df.select(*[F.col(c).cast("double").alias(c) if c in wanted else F.col(c) for c in df.columns])


def predict_boosted_trees(
    model, df: DataFrame, features: Sequence[str], target: str, order: SeriesOrder = SeriesOrder()
) -> DataFrame:
    scored = model.transform(_doubles(df, features, target))
    return scored.select(order.key, order.time, F.col(target).alias("y_true"), "y_pred")


