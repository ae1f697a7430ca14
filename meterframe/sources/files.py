"""CSV files with a header."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleaning import nan_to_null
from ..schemas import METADATA, READINGS, REGIONS

# Texts that mean a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.when(~F.trim(F.col(f"`{name}`")).isin(*MISSING_TEXTS), F.col(f"`{name}`"))
    return text.cast(kind).alias(name)


def files_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Header line -> files.  One job finds the line that stands first in each
    file; what reaches the driver is a line per file, as a listing would."""
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )

    def first_line(batches):
        seen = set()
        for batch in batches:
            new = ~(batch["file"].isin(seen) | batch["file"].duplicated())
            seen.update(batch.loc[new, "file"])
            yield batch.loc[new, ["file", "value"]]

    heads = lines.where("block = 0").select("file", "value").mapInPandas(first_line, "file string, value string")
    found: dict[str, list[str]] = {}
    for row in heads.collect():
        found.setdefault(row["value"].removeprefix("\ufeff"), []).append(row["file"])
    return {head: sorted(files) for head, files in sorted(found.items())}


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Files, folders or globs below each other, columns matched by each file's
    own header; a column that a file lacks is null.  Files that share a header
    are one scan."""
    frames = []
    for files in files_by_header(spark, [paths] if isinstance(paths, str) else paths).values():
        # Names and places come from the header that all these files have.
        text = spark.read.option("header", True).option("enforceSchema", False).csv(files)
        frames.append(text.select(*[_typed(f.name, f.dataType) for f in schema.fields if f.name in text.columns]))
    if not frames:
        return spark.createDataFrame([], schema)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    found = set(whole.columns)
    return nan_to_null(
        whole.select(
            *[
                F.col(f.name) if f.name in found else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )
    )


def read_readings(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Meter readings as delivered: times are still text, nothing is stamped."""
    fields = [
        T.StructField("timestamp", T.StringType()) if f.name == "timestamp" else f
        for f in READINGS.fields
        if f.name != "ingested_at"
    ]
    return read_csv(spark, paths, T.StructType(fields))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, METADATA)


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, REGIONS)
