"""Rows whose own columns stay together in one column, ``row``, while others are
joined to them: columns of a table may then have any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boxed(df: DataFrame) -> DataFrame:
    return df.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row"))


def own(name: str) -> Column:
    return F.col("row")[name]


def unboxed(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """The rows' columns, and further ones."""
    return df.select(*[own(c).alias(c) for c in columns], *more)
