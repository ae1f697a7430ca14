"""Catalog tables of the raw layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import nan_to_null
from ..schemas import METADATA, READINGS, REGIONS, TABLES, WEATHER

# Table names.
TABLE_NAMES = {
    "region": "region_centers",
    "customer_metadata": "raw_customer_metadata",
    "smart_meter": "raw_smart_meter_readings",
    "weather": "raw_weather",
}
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


def create_raw_tables(spark: SparkSession, location: str, prefix: str = "") -> list[str]:
    """CREATE TABLE IF NOT EXISTS for the four tables, as Parquet below
    ``location``.  Safe to run again.  Keys are checked by ``quality``."""
    made = []
    for table, rules in TABLES.items():
        name = prefix + TABLE_NAMES[table]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rules.schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location.rstrip('/')}/{name}'"
        )
        made.append(name)
    return made


def load_dataframe(df: DataFrame, table: str, if_exists: str = "append") -> None:
    """Write into an existing table, columns matched by name; ``replace``
    swaps the content, ``fail`` refuses a table that holds rows."""
    spark = df.sparkSession
    target = spark.table(table)
    if if_exists not in ("append", "replace", "fail"):
        raise ValueError(f"if_exists must be append, replace or fail, not {if_exists!r}")
    if if_exists == "fail" and not target.isEmpty():
        raise ValueError(f"table {table} is not empty")
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])
    rows.write.insertInto(table, overwrite=if_exists == "replace")


def _dependents(table: str) -> list[str]:
    """The table and all tables that refer to it, directly or not."""
    found = [table]
    for name in found:
        for other, rules in TABLES.items():
            if other not in found and any(parent == name for _, parent, _ in rules.foreign_keys):
                found.append(other)
    return found


def truncate_table(spark: SparkSession, table: str, prefix: str = "") -> list[str]:
    """Empty a table and, as a cascade, those whose foreign keys lead to it."""
    emptied = []
    for name in _dependents(table):
        full = prefix + TABLE_NAMES[name]
        if spark.catalog.tableExists(full):
            spark.createDataFrame([], spark.table(full).schema).write.insertInto(full, overwrite=True)
            emptied.append(full)
    return emptied


def validate_at_date(at_date: str) -> datetime:
    """Accept ``YYYY-MM-DD HH:MM:SS`` only."""
    try:
        return datetime.strptime(at_date, TIME_FORMAT)
    except ValueError as error:
        raise ValueError(f"{at_date!r} is no time of the form {TIME_FORMAT}") from error


def ingested_after(at_date: str) -> Column:
    moment = validate_at_date(at_date)
    return F.col("ingested_at") > F.lit(str(moment)).cast("timestamp_ntz")


def _load(df: DataFrame, columns: list[str], at_date: str | None) -> DataFrame:
    """Explicit projection; later than ``at_date`` only, if one is given.
    Both reach the Parquet scan."""
    rows = df if at_date is None else df.where(ingested_after(at_date))
    return nan_to_null(rows.select(*columns))


def load_sm_metadata(df: DataFrame) -> DataFrame:
    return _load(df, METADATA.fieldNames(), None)


def load_regions(df: DataFrame) -> DataFrame:
    return _load(df, REGIONS.fieldNames(), None)


def load_sm_data(df: DataFrame, at_date: str | None = None) -> DataFrame:
    return _load(df, READINGS.fieldNames(), at_date)


def load_weather_data(df: DataFrame, at_date: str | None = None) -> DataFrame:
    return _load(df, WEATHER.fieldNames(), at_date)
