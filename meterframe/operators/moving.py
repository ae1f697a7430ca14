"""Ridge regression per meter on a span of periods that moves on.

The sums of products of a period's rows, such as a month's, are stored once per
meter.  A fit adds up the stored sums of the periods in its span: a span that
moves by a month reads that month's rows and no others, and nothing is taken away
from a running sum that rounding could spoil.

Sums are taken about a centre that a meter keeps from its first period on, and
moved to the span's means when it is fitted.  Presence of each value is summed
alongside, so a missing feature stands at the mean of whatever span is fitted, as
in ``models.fit_ridge``.  A feature whose spread within the span is below
``FLAT`` of its distance from the centre is taken as constant there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import finite
from ..session import create_once, durable, list_names
from .models import SALTS, _added_up, _products, _solve

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FLAT = 1e-5


def _about_means(products: np.ndarray, size: int, centre: np.ndarray):
    """(upper triangle about the means, rows, means) from the triangle of
    [values about the centre, presence]."""
    full = np.zeros((2 * size, 2 * size))
    full[np.triu_indices(2 * size)] = products
    full = full + np.triu(full, 1).T
    values, sums, both = full[:size, :size], full[:size, size:], full[size:, size:]
    seen = np.diag(both)
    shift = np.divide(np.diag(sums), seen, out=np.zeros(size), where=seen > 0)
    moved = values - shift[:, None] * sums.T - sums * shift[None, :] + both * np.outer(shift, shift)
    flat = np.diag(moved) <= FLAT**2 * seen * shift**2
    flat[-1] = False  # the target may well be constant
    moved[flat, :] = 0.0
    moved[:, flat] = 0.0
    means = np.where(seen > 0, centre + shift, np.nan)
    return moved[np.triu_indices(size)], int(seen[-1]), means


@dataclass(frozen=True)
class MovingRidge:
    """Stored sums below the folder ``root``, and fits from them."""

    spark: SparkSession = field(repr=False)
    root: str
    features: Sequence[str]
    target: str
    key: str = "object_id"

    def periods(self) -> list[str]:
        return list_names(self.spark, f"{self.root}/done")

    def _read(self, name: str, periods: Sequence[str]) -> DataFrame | None:
        paths = [f"{self.root}/{name}/{p}" for p in periods]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, rows: DataFrame, period: str) -> bool:
        """Add a period's rows; False if it is there already.  One that was cut
        off is added again from the start."""
        done = self.periods()
        if period in done:
            return False
        key, columns = self.key, [*self.features, self.target]
        size = len(columns)
        names = [f"__{i}" for i in range(size)]
        rows = rows.select(F.col(key), *[finite(F.col(c).cast("double")).alias(n) for c, n in zip(columns, names)])
        rows = rows.where(F.col(names[-1]).isNotNull() & F.col(key).isNotNull())
        first = rows.groupBy(key).agg(F.array(*[F.coalesce(F.avg(n), F.lit(0.0)) for n in names]).alias("centre"))
        known = self._read("centres", done)
        if known is not None:
            first = first.join(known.select(key), key, "left_anti")
        first.write.mode("overwrite").parquet(f"{self.root}/centres/{period}")
        centres = self._read("centres", [*done, period])
        centred = F.array(
            *[F.coalesce(F.col(n) - F.col("centre")[i], F.lit(0.0)) for i, n in enumerate(names)],
            *[F.col(n).isNotNull().cast("double") for n in names],
        )
        salted = rows.join(centres, key).select(key, centred.alias("centred"))
        salted = salted.withColumn("__salt", F.pmod(F.xxhash64("centred"), F.lit(SALTS)))
        by_salt = salted.repartition(key, "__salt").drop("__salt").sortWithinPartitions(key)
        sums = f"`{key}` {dict(rows.dtypes)[key]}, products array<double>"
        met = by_salt.mapInPandas(_products(key), sums).repartition(key).sortWithinPartitions(key)
        met.mapInPandas(_added_up(key), sums).write.mode("overwrite").parquet(f"{self.root}/sums/{period}")
        create_once(self.spark, f"{self.root}/done/{period}", "")
        return True

    def fit(self, periods: Sequence[str], penalty: float = 1.0) -> DataFrame:
        """Models of the rows in these periods, as ``models.fit_ridge`` gives
        them; only stored sums are read."""
        done = self.periods()
        absent = [p for p in periods if p not in done]
        if absent or not periods:
            raise ValueError(f"periods {absent or '(none given)'} are not stored")
        key, size = self.key, len(self.features) + 1
        stored = self._read("sums", list(dict.fromkeys(periods)))
        sums = f"`{key}` {dict(stored.dtypes)[key]}, products array<double>"
        added = stored.repartition(key).sortWithinPartitions(key).mapInPandas(_added_up(key), sums)

        def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = {"rows": [], "intercept": [], "level": [], "weights": [], "means": []}
                for products, centre in zip(batch["products"], batch["centre"]):
                    about, n, means = _about_means(products, size, np.array(centre, float))
                    at = np.nan_to_num(means[:-1])
                    weights = _solve(about, n, size, at, penalty)
                    out["rows"].append(n)
                    out["intercept"].append(float(means[-1] - weights @ at))
                    out["level"].append(float(means[-1]))
                    out["weights"].append(weights)
                    out["means"].append([None if np.isnan(m) else m for m in means[:-1]])
                yield pd.DataFrame({key: batch[key], **out})

        kind = dict(stored.dtypes)[key]
        return added.join(self._read("centres", done), key).mapInPandas(
            solved, f"`{key}` {kind}, rows bigint, intercept double, level double, weights array<double>, means array<double>"
        )

    def fit_stored(self, periods: Sequence[str], penalty: float = 1.0) -> DataFrame:
        """The same, written below the shared folder and read back."""
        return durable(self.fit(periods, penalty), "moving")
