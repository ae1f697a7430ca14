"""One feature table to separate import and export tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECTIONS = ("import", "export")  # fixed values


def _neutral(column: str, direction: str) -> str:
    """``energy_import_kwh`` -> ``energy_kwh``, ``import_lag_1`` -> ``lag_1``"""
    name = column.replace(f"energy_{direction}_kwh", "energy_kwh")
    return name.removeprefix(f"{direction}_")


def _of(column: str, direction: str) -> bool:
    return f"energy_{direction}_kwh" in column or column.startswith(f"{direction}_")


def split_by_direction(df: DataFrame, direction: str) -> DataFrame:
    """Shared columns plus those of one direction under neutral names."""
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {DIRECTIONS}")
    (other,) = [d for d in DIRECTIONS if d != direction]
    return df.select(*[F.col(c).alias(_neutral(c, direction)) for c in df.columns if not _of(c, other)])


def energy_import_export_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_by_direction(df, "import"), split_by_direction(df, "export")


def stack_directions(df: DataFrame) -> DataFrame:
    """Both directions below each other with a ``direction`` column."""
    one, two = (split_by_direction(df, d).withColumn("direction", F.lit(d)) for d in DIRECTIONS)
    return one.unionByName(two)
