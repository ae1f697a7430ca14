"""Incremental reads of a growing raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import nan_to_null
from ..sources.tables import ingested_after


def readings_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    at_date: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """New files of a Parquet folder as a stream; the file list already read
    is kept in the query's checkpoint."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    rows = nan_to_null(rows)
    return rows if at_date is None else rows.where(ingested_after(at_date))


def append_new(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived since the last call, then stop.  The file sink
    and the checkpoint together write each row once, also after a failure."""
    return (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
