"""Readings stored by meter and time.

A catalog table in buckets of (meter, part), sorted by time within, one file a
bucket.  Windows over a meter's past then find their rows in place: no exchange
and no sort above the scan, however often features are built.

A meter above the limit of ``operators.series`` is stored in its parts, each with
the rows before it that features look back to, so no bucket holds such a meter as
a whole.  Features may look back at most ``lookback`` rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.series import BASE, HALO, PART, SeriesOrder, SeriesParts

PREFIX = "meterframe."


@dataclass(frozen=True)
class StoredSeries:
    table: str
    order: SeriesOrder
    lookback: int

    def parts(self) -> SeriesParts:
        """Parts as stored; they need not be measured or opened again."""
        return SeriesParts(self.order, self.lookback, bins=(None, None, None, None))

    def build(self, spark: SparkSession, feature: Callable[[DataFrame, SeriesParts], DataFrame]) -> DataFrame:
        """Features of all rows, such as ``lambda df, parts: add_lags(df, [24], parts)``."""
        parts = self.parts()
        return parts.close(feature(spark.table(self.table), parts))

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.parts().close(spark.table(self.table))


def store_series(
    df: DataFrame,
    table: str,
    path: str,
    lookback: int,
    buckets: int,
    order: SeriesOrder = SeriesOrder(),
    part_rows: int | None = None,
) -> StoredSeries:
    """Write a panel as a new table at ``path``.  ``buckets`` is the number of
    tasks that read it later (``session.partitions_for``)."""
    parts = SeriesParts.measure(df, order, lookback, part_rows=part_rows)
    opened = parts.open(df)
    if not parts.is_cut:
        opened = opened.select(
            "*", F.lit(0).cast("bigint").alias(PART), F.lit(False).alias(HALO), F.lit(0).cast("bigint").alias(BASE)
        )
    opened = opened.withColumn(PART, F.col(PART).cast("bigint")).withColumn(BASE, F.col(BASE).cast("bigint"))
    keys = [order.key, PART]
    # The same hash as the buckets': each task writes one bucket, as one file.
    (
        opened.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys, *order.sort)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    said = {"key": order.key, "time": order.time, "ties": ",".join(order.ties), "lookback": str(lookback)}
    listed = ", ".join(f"'{PREFIX}{k}' = '{v}'" for k, v in said.items())
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    return StoredSeries(table, order, lookback)


def stored_series(spark: SparkSession, table: str) -> StoredSeries:
    """A table that ``store_series`` wrote."""
    said = {r["key"][len(PREFIX):]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"].startswith(PREFIX)}
    if "lookback" not in said:
        raise ValueError(f"{table} is not stored by meter and time")
    ties = tuple(c for c in said["ties"].split(",") if c)
    return StoredSeries(table, SeriesOrder(said["key"], said["time"], ties), int(said["lookback"]))
