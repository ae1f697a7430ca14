"""Run results kept as Parquet tables with a folder per run."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_KEYS = ("category", "model", "run_id")


def make_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("run_%Y%m%d_%H%M%S")


def metrics_as_rows(metrics: DataFrame) -> DataFrame:
    """A one-row frame of numbers as (key, value) texts."""
    texts = metrics.select(*[F.col(c).cast("string").alias(c) for c in metrics.columns])
    return texts.unpivot([], texts.columns, "key", "value")


def write_run(frame: DataFrame, root: str, table: str, marks: Mapping[str, str]) -> str:
    """Write a run's rows to a ledger table, in a folder of their own, and
    return that folder.  A run that is written again replaces itself."""
    folder = "/".join([root.rstrip("/"), table, *[f"{k}={marks[k]}" for k in RUN_KEYS]])
    frame.write.mode("overwrite").parquet(folder)
    return folder


def settings_as_rows(spark: SparkSession, settings: Mapping[str, object]) -> DataFrame:
    """A run's settings, a few dozen, as (param, value) texts.  The entries of
    an inner mapping are named ``outer.inner``; lists are joined by commas; a
    missing value is null."""

    def text(value: object) -> str | None:
        if isinstance(value, (list, tuple)):
            return ",".join(map(str, value))
        return None if value is None else str(value)

    named = [((k, i), v) for k, inner in settings.items() if isinstance(inner, Mapping) for i, v in inner.items()]
    named += [((k,), v) for k, v in settings.items() if not isinstance(v, Mapping)]
    return spark.createDataFrame([(".".join(map(str, name)), text(v)) for name, v in named], "param string, value string")


def read_runs(spark: SparkSession, path: str, **marks: str) -> DataFrame:
    """Ledger rows; given marks select folders, not rows."""
    runs = spark.read.parquet(path)
    for key, value in marks.items():
        runs = runs.where(F.col(key) == value)
    return runs


def flatten_params(df: DataFrame, key: str) -> DataFrame:
    """Settings stored as columns, one row a run, as (key, param, value) rows: a
    map column gives ``column.entry``, an array is joined by ','."""

    def entries(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.MapType):
            return F.transform(
                F.map_entries(c),
                lambda e: F.struct(
                    F.concat(F.lit(f"{field.name}."), e["key"]).alias("param"),
                    e["value"].cast("string").alias("value"),
                ),
            )
        if isinstance(field.dataType, T.ArrayType):
            text = F.array_join(c.cast("array<string>"), ",")
        else:
            text = c.cast("string")
        return F.array(F.struct(F.lit(field.name).alias("param"), text.alias("value")))

    fields = [f for f in df.schema.fields if f.name != key]
    return df.select(key, F.inline(F.concat(*[entries(f) for f in fields])))
