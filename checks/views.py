"""The given tables seen as meters, in Spark and in SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterframe.operators.series import SeriesOrder
from meterframe.schemas import READINGS, WEATHER

ORDER = SeriesOrder(ties=("event_id",))
HOURLY = SeriesOrder()

BOUNDS = {
    "rolling_offset": (datetime(2024, 1, 1), datetime(2024, 1, 8)),
    "train": (datetime(2024, 1, 8), datetime(2024, 1, 20)),
    "dev": (datetime(2024, 1, 20), datetime(2024, 1, 25)),
    "test": (datetime(2024, 1, 25), datetime(2024, 1, 31)),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a reading of the user's meter; two meters per customer."""
    return table(spark, sf, "events").select(
        F.expr("user_id div 2").cast("string").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("object_id"),
        (F.col("user_id") + 1000).alias("metering_point_id"),
        F.expr("nullif(event_type, 'error')").alias("tariff_code"),
        F.col("value").alias("energy_import_kwh"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("double") / 10).alias("energy_export_kwh"),
        F.col("ts").alias("ingested_at"),
        "event_id",
    )


def energy(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf).select(
        "object_id", "timestamp", "event_id", F.col("energy_import_kwh").alias("energy_kwh")
    )


def energy_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The same, with failed readings (type 'error') as missing values."""
    return readings(spark, sf).select(
        "object_id",
        "timestamp",
        "event_id",
        F.when(F.col("tariff_code").isNotNull(), F.col("energy_import_kwh")).alias("energy_kwh"),
    )


def doubled(spark: SparkSession, sf: str) -> DataFrame:
    """Readings by the hour with natural duplicates, moved to October."""
    return readings(spark, sf).withColumn(
        "timestamp", F.date_trunc("hour", F.col("timestamp") + F.expr("INTERVAL 9 MONTH")).cast("timestamp_ntz")
    )


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """One row per meter and hour, as readings."""
    stamped = readings(spark, sf).withColumn(
        "timestamp", F.date_trunc("hour", F.col("timestamp")).cast("timestamp_ntz")
    )
    return stamped.groupBy("object_id", "timestamp").agg(
        (F.sum(F.rint(F.col("energy_import_kwh") * 100).cast("bigint")) / 100.0).alias("energy_import_kwh")
    )


def series_hour(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly totals per event type: few, long series."""
    return (
        table(spark, sf, "events")
        .groupBy(
            F.col("event_type").alias("object_id"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"),
        )
        .agg((F.sum(F.rint(F.col("value") * 100).cast("bigint")) / 100.0).alias("energy_kwh"))
    )


def regions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.col("r_regionkey").alias("region_id"),
        (F.col("r_regionkey") + 56.0).alias("center_latitude"),
        (F.col("r_regionkey") + 21.0).alias("center_longitude"),
    )


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey", "n_name")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.expr("c_custkey div 2").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_custkey").cast("string").alias("object_id"),
            F.col("n_name").alias("object_address"),
            (F.col("c_custkey") + 1000).alias("metering_point_id"),
            F.col("c_mktsegment").alias("tariff_code"),
            (F.col("n_regionkey") + 56.5).alias("address_latitude"),
            (F.col("n_regionkey") + 21.5).alias("address_longitude"),
            F.col("n_regionkey").alias("region_id"),
        )
    )


def weather_hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly 'weather' per region from the region's events."""
    where = metadata(spark, sf).select("object_id", "region_id")
    export10 = F.rint(F.col("energy_export_kwh") * 10).cast("bigint")
    return (
        readings(spark, sf)
        .join(where, "object_id")
        .groupBy(
            F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("timestamp"), "region_id"
        )
        .agg(
            F.min("energy_import_kwh").alias("temperature_2m"),
            F.max("energy_export_kwh").alias("rain"),
            F.min("energy_export_kwh").alias("snowfall"),
            F.count(F.lit(1)).alias("cloud_cover"),
            F.max(export10).alias("weather_code"),
            F.count("tariff_code").alias("is_day"),
            F.max("energy_import_kwh").alias("wind_speed_10m"),
            F.sum(export10).alias("relative_humidity_2m"),
            F.min(export10).alias("apparent_temperature"),
            F.count_if(F.col("tariff_code").isNull()).alias("precipitation"),
        )
    )


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """The historical rows and the same again as forecast rows."""
    both = weather_hours(spark, sf).select(
        "*",
        F.explode(F.array(F.lit("historical"), F.lit("forecast"))).alias("data_type"),
        F.col("timestamp").alias("ingested_at"),
    )
    return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in WEATHER.fields])


READING_COLUMNS = READINGS.fieldNames()

SQL_VIEWS = {
    "readings": """
        SELECT CAST(user_id // 2 AS VARCHAR) AS customer_id, ts AS "timestamp",
               CAST(user_id AS VARCHAR) AS object_id, user_id + 1000 AS metering_point_id,
               nullif(event_type, 'error') AS tariff_code, value AS energy_import_kwh,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 10 AS energy_export_kwh,
               ts AS ingested_at, event_id
        FROM events""",
    "energy": """
        SELECT object_id, "timestamp", event_id, energy_import_kwh AS energy_kwh,
               CAST(round(energy_import_kwh * 100) AS HUGEINT) AS cents
        FROM readings""",
    "energy_gaps": """
        SELECT object_id, "timestamp", event_id,
               CASE WHEN tariff_code IS NOT NULL THEN energy_import_kwh END AS energy_kwh,
               CASE WHEN tariff_code IS NOT NULL
                    THEN CAST(round(energy_import_kwh * 100) AS HUGEINT) END AS cents
        FROM readings""",
    "doubled": """
        SELECT * REPLACE (date_trunc('hour', "timestamp" + INTERVAL 9 MONTH) AS "timestamp")
        FROM readings""",
    "hourly": """
        SELECT object_id, date_trunc('hour', "timestamp") AS "timestamp",
               CAST(sum(CAST(round(energy_import_kwh * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS energy_import_kwh
        FROM readings GROUP BY ALL""",
    "series_hour": """
        SELECT event_type AS object_id, date_trunc('hour', ts) AS "timestamp",
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS energy_kwh,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS HUGEINT) AS cents
        FROM events GROUP BY 1, 2""",
    "regions": """
        SELECT r_regionkey AS region_id, r_regionkey + 56.0::DOUBLE AS center_latitude,
               r_regionkey + 21.0::DOUBLE AS center_longitude
        FROM region""",
    "metadata": """
        SELECT CAST(c_custkey // 2 AS VARCHAR) AS customer_id, c_name AS customer_name,
               CAST(c_custkey AS VARCHAR) AS object_id, n_name AS object_address,
               c_custkey + 1000 AS metering_point_id, c_mktsegment AS tariff_code,
               n_regionkey + 56.5::DOUBLE AS address_latitude,
               n_regionkey + 21.5::DOUBLE AS address_longitude, n_regionkey AS region_id
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "weather_hours": """
        SELECT date_trunc('hour', r."timestamp") AS "timestamp", m.region_id,
               CAST(CAST(min(energy_import_kwh) AS FLOAT) AS DOUBLE) AS temperature_2m,
               CAST(CAST(max(energy_export_kwh) AS FLOAT) AS DOUBLE) AS rain,
               CAST(CAST(min(energy_export_kwh) AS FLOAT) AS DOUBLE) AS snowfall,
               CAST(count(*) AS DOUBLE) AS cloud_cover,
               CAST(max(CAST(round(energy_export_kwh * 10) AS BIGINT)) AS DOUBLE) AS weather_code,
               CAST(count(r.tariff_code) AS DOUBLE) AS is_day,
               CAST(CAST(max(energy_import_kwh) AS FLOAT) AS DOUBLE) AS wind_speed_10m,
               CAST(sum(CAST(round(energy_export_kwh * 10) AS BIGINT)) AS DOUBLE) AS relative_humidity_2m,
               CAST(min(CAST(round(energy_export_kwh * 10) AS BIGINT)) AS DOUBLE) AS apparent_temperature,
               CAST(count(*) - count(r.tariff_code) AS DOUBLE) AS precipitation
        FROM readings r JOIN metadata m ON r.object_id = m.object_id
        GROUP BY 1, 2""",
    "weather": """
        SELECT w.*, d.data_type, w."timestamp" AS ingested_at
        FROM weather_hours w, (VALUES ('historical'), ('forecast')) d(data_type)""",
}
