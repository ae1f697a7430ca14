"""Weather beside readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_region(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join of the region; ids are compared as text.

    No broadcast is forced: there is one metadata row per meter, so its size
    grows with the data.  Spark broadcasts it below its size threshold and
    otherwise sorts, splitting skewed partitions at run time.
    """
    regions = metadata.select(F.col("object_id").cast("string").alias("object_id"), "region_id")
    return df.withColumn("object_id", F.col("object_id").cast("string")).join(regions, "object_id", "left")


def join_hours(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Left join of weather on (time, region).  Columns that occur on both
    sides get ``_x`` and ``_y``."""
    keys = ["timestamp", "region_id"]
    shared = [c for c in weather.columns if c in df.columns and c not in keys]
    left = df.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = weather.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return left.join(right, keys, "left")


def join_weather(
    df: DataFrame,
    metadata: DataFrame,
    weather: DataFrame,
    data_type: str | None = "historical",
) -> DataFrame:
    """Readings with the weather of their region and hour.

    Weather is unique per (time, region, data type), so one ``data_type`` keeps
    one row per reading.  ``None`` joins all of them: readings then repeat for
    each type.
    """
    if data_type is not None:
        weather = weather.where(F.col("data_type") == data_type)
    return join_hours(join_region(df, metadata), weather)
