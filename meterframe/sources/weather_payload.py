"""Hourly weather payloads (start, step, one array per variable) as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.series import GROUP_LIMIT, SeriesOrder, over_series
from ..schemas import WEATHER_VARIABLES

MODES = ("historical", "forecast")  # fixed values
EPOCH = "1970-01-01 00:00:00"
BACKTEST_SPAN = ("2017-04-01", "2020-04-01")  # fixed values


def check_request(mode: str, start_date: str | None = None, end_date: str | None = None) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "historical" and (start_date is None or end_date is None):
        raise ValueError("historical mode needs start_date and end_date")


def explode_payload(
    payloads: DataFrame, ids: Sequence[str], variables: Sequence[str] = WEATHER_VARIABLES
) -> DataFrame:
    """One row per step from start (inclusive) to end (exclusive).  The local
    offset is one number per payload, so hours never repeat."""
    first = F.col("start_epoch") + F.col("offset_s")
    last = F.col("end_epoch") + F.col("offset_s") - 1
    step = F.col("step_s").cast("bigint")
    moments = F.when(F.col("end_epoch") > F.col("start_epoch"), F.sequence(first, last, step))
    steps = payloads.select("*", F.posexplode(moments).alias("__i", "__s"))
    time = F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("__s").cast("decimal(18,6)"))
    return steps.select(
        *ids, time.alias("timestamp"), *[F.get(F.col(v), F.col("__i")).alias(v) for v in variables]
    )


def first_hours(df: DataFrame, hours: int, key: str = "region_id", time: str = "timestamp") -> DataFrame:
    """The first ``hours`` rows of each region and when they start.  Up to
    ``GROUP_LIMIT`` rows, Spark keeps that many per region in each map task
    already; beyond it, large regions are cut into parts."""
    order = SeriesOrder(key, time)
    if hours <= GROUP_LIMIT:
        placed = df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(time)))
        first = placed.where(F.col("__n") <= hours).drop("__n")
    else:
        first = over_series(
            df,
            None,
            lambda frame, p: frame.withColumn("__n", p.position()).where(F.col("__n") < hours).drop("__n"),
            lookback=0,
            order=order,
        )
    return with_start(first, key, time)


def weather_by_region(
    payloads: DataFrame,
    regions: DataFrame,
    mode: str,
    start_date: str | None = None,
    end_date: str | None = None,
    horizon_hours: int | None = None,
    variables: Sequence[str] = WEATHER_VARIABLES,
) -> DataFrame:
    """Rows of all regions with their ``data_type``; a forecast may be cut to
    its first hours.  Payloads carry ``region_id``."""
    check_request(mode, start_date, end_date)
    known = payloads.join(regions.select("region_id"), "region_id", "left_semi")
    rows = explode_payload(known, ["region_id"], variables).withColumn("data_type", F.lit(mode))
    if mode == "forecast":
        if horizon_hours is not None:
            rows = first_hours(rows, horizon_hours)
        else:
            rows = with_start(rows)
        rows = rows.withColumn("horizon_hours", F.lit(horizon_hours).cast("int"))
    return rows


def with_start(df: DataFrame, key: str = "region_id", time: str = "timestamp") -> DataFrame:
    """``forecast_start``: each region's first time, from one row per region."""
    starts = df.groupBy(key).agg(F.min(time).alias("forecast_start"))
    return df.join(starts, key, "left")


def pull_weather(
    mode: str, payloads: DataFrame, regions: DataFrame, variables: Sequence[str] = WEATHER_VARIABLES
) -> DataFrame | None:
    """Historical weather of the backtest span; no other mode has any."""
    if mode != "backtest":
        return None
    return weather_by_region(payloads, regions, "historical", *BACKTEST_SPAN, variables=variables)


def write_weather(df: DataFrame, path: str) -> str:
    """A folder per data type and region, and for forecasts per start and
    horizon: a later forecast stands beside an earlier one, and one that is
    written again replaces itself."""
    for name in ("forecast_start", "horizon_hours"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    text = df.withColumn("forecast_start", F.date_format(F.col("forecast_start").cast("timestamp_ntz"), "yyyy-MM-dd'T'HH-mm"))
    folders = ("data_type", "region_id", "forecast_start", "horizon_hours")
    text.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)
    return path
