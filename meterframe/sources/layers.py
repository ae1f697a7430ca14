"""Parquet datasets by layer: original -> raw -> processed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import nan_to_null

# Layer folders below the data root.
LAYERS = {"original": "original", "raw": "raw", "processed": "processed"}


def layer_path(root: str, layer: str, name: str, category: str | None = None) -> str:
    folder = LAYERS.get(layer.lower())
    if folder is None:
        raise ValueError(f"invalid layer '{layer}', expected one of {list(LAYERS)}")
    return "/".join(p for p in (root.rstrip("/"), folder, category, f"{name}.parquet") if p)


def load_parquet(
    spark: SparkSession, root: str, layer: str, name: str, category: str | None = None
) -> DataFrame:
    path = layer_path(root, layer, name, category)
    try:
        return nan_to_null(spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"'{path}' does not exist") from error
        raise


def write_parquet(df: DataFrame, root: str, layer: str, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """Overwrite a dataset and return its path; an empty frame is an error and
    leaves the dataset as it was."""
    path = layer_path(root, layer, name)
    if df.isEmpty():
        raise ValueError("the frame is empty, nothing to write")
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("timestamp", "yyyy-MM"))


def export_raw_layer(root: str, metadata: DataFrame, readings: DataFrame, weather: DataFrame) -> dict[str, str]:
    """The three raw datasets; the two time series lie in a folder per month,
    so a reader of a time span lists only its months."""
    return {
        "smart_meter_metadata": write_parquet(metadata, root, "raw", "smart_meter_metadata"),
        "smart_meter_readings": write_parquet(
            _by_month(readings), root, "raw", "smart_meter_readings", ("month",)
        ),
        "weather": write_parquet(_by_month(weather), root, "raw", "weather", ("month",)),
    }
