"""Encoding, scaling and storage width of feature columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rounding import HALF_MAX, quantize_half
from ..joins import meet
from ..session import durable

# Categories of the calendar columns.
DOMAINS = {"weekday": tuple(range(7)), "hour": tuple(range(24))}


def normalize_bool_columns(df: DataFrame) -> DataFrame:
    flags = {f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)}
    return df.select(*[F.col(c).cast("tinyint").alias(c) if c in flags else F.col(c) for c in df.columns])


def categories(df: DataFrame, column: str) -> list:
    """The values of a column, in order.  Each becomes a column of the result,
    so the driver has to know them all, however many there are; for a column of
    many values use ``one_hot_sparse``."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct()
    return sorted(r[0] for r in found.collect())


def one_hot(
    df: DataFrame, columns: Sequence[str], domains: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """``{column}_{value}`` as 0/1 beside the column itself; null gives zeros.

    With a known domain the columns do not depend on the data and no pass over
    it is needed.
    """
    known = {**DOMAINS, **(domains or {})}
    out = []
    for c in columns:
        if c not in df.columns:
            raise KeyError(f"column '{c}' not found")
        for v in known[c] if c in known else categories(df, c):
            out.append(F.when(F.col(c) == F.lit(v), 1).otherwise(0).cast("tinyint").alias(f"{c}_{v}"))
    return df.select("*", *out)


def category_codes(values: DataFrame, column: str) -> DataFrame:
    """(value, code): the values of a column, numbered from 0 in their order.

    Values are sorted and numbered in parts by range, whose sizes (one row a
    part) say where each begins; no task holds them all.
    """
    found = values.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    placed = durable(found.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "categories")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("value"))
    return placed.join(F.broadcast(starts), "part").select("value", (F.col("start") + within - 1).alias("code"))


def one_hot_sparse(
    df: DataFrame, columns: Sequence[str], codes: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """One-hot in sparse form, for columns of any number of values: the place of
    the 1 as ``{column}_index``, and ``{column}_value``, 1 or 0 if there is none.

    ``codes`` are tables of (value, code), as ``category_codes`` gives them for the
    rows a model is fitted on; a column without takes its own.  Nulls, and values
    that the codes do not hold, have no index.  Values that many rows share do not
    gather in one task.  Column names that begin with two underscores are kept free.
    """
    for c in columns:
        if c not in df.columns:
            raise KeyError(f"column '{c}' not found")
    for c in columns:
        held = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
        held = durable(held, "held")
        known = codes[c] if codes and c in codes else category_codes(held, "__value")
        known = known.select(F.col("value").alias("__value"), F.col("code").cast("bigint").alias("__code"))
        facts = durable(held.join(known, "__value", "left"), "coded")
        rows = df.withColumn("__value", F.col(c))
        coded = meet(rows.where(F.col("__value").isNotNull()), facts, ["__value"], "__n").select(*df.columns, "__code")
        blank = rows.where(F.col("__value").isNull()).select(*df.columns, F.lit(None).cast("bigint").alias("__code"))
        df = coded.unionByName(blank).select(
            *df.columns,
            F.col("__code").alias(f"{c}_index"),
            F.col("__code").isNotNull().cast("tinyint").alias(f"{c}_value"),
        )
    return df


def float_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in exclude
    ]


def fit_zscore(df: DataFrame, exclude: Sequence[str] = ("energy_kwh",)) -> DataFrame:
    """(feature, mean, std), one row per float column; one pass."""
    columns = float_columns(df, exclude)
    stats = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
                for c in columns
            ]
        ).alias("stats")
    )
    return stats.select(F.inline("stats"))


def apply_zscore(
    df: DataFrame,
    stats: Mapping[str, tuple[float, float]],
    exclude: Sequence[str] = ("energy_kwh",),
) -> DataFrame:
    """Scale by given statistics; a column without spread stays as it is."""

    def scaled(c: str) -> Column:
        mean, std = stats[c]
        if std is None or not std > 0:
            return F.col(c)
        return ((F.col(c) - F.lit(mean)) / F.lit(std)).alias(c)

    wanted = set(float_columns(df, exclude))
    return df.select(*[scaled(c) if c in wanted else F.col(c) for c in df.columns])


def zscore_scale_float_columns(
    df: DataFrame,
    exclude: Sequence[str] = ("energy_kwh",),
    stats: Mapping[str, tuple[float, float]] | None = None,
) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Fit on ``df`` unless ``stats`` are given, then scale."""
    if stats is None:
        # one row per column
        stats = {r["feature"]: (r["mean"], r["std"]) for r in fit_zscore(df, exclude).collect()}
    return apply_zscore(df, stats, exclude), dict(stats)


def downcast_floats(df: DataFrame, exclude: Sequence[str] = (), half: bool = False) -> DataFrame:
    """Float columns to FLOAT.  With ``half`` a column whose values all lie in
    the half-precision range is rounded to that precision first; columns of
    nulls stay as they are."""
    columns = float_columns(df, exclude)
    if not columns:
        return df
    bounds = df.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(columns)],
    ).first()

    def narrow(c: str) -> Column:
        i = columns.index(c)
        lo, hi = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        if lo is None:
            return F.col(c)
        value = F.col(c)
        if half and -HALF_MAX <= lo <= hi <= HALF_MAX:
            value = quantize_half(value.cast("double"))
        return value.cast("float").alias(c)

    return df.select(*[narrow(c) if c in columns else F.col(c) for c in df.columns])
