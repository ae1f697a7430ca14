"""Table schemas and the constraints that belong to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The hourly weather variables, in payload order.
WEATHER_VARIABLES = (
    "temperature_2m",
    "rain",
    "snowfall",
    "cloud_cover",
    "weather_code",
    "is_day",
    "wind_speed_10m",
    "relative_humidity_2m",
    "apparent_temperature",
    "precipitation",
)


INT, LONG, DOUBLE, FLOAT = T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType()
TEXT, TIME = T.StringType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


REGIONS = _struct(region_id=INT, center_latitude=DOUBLE, center_longitude=DOUBLE)

METADATA = _struct(
    customer_id=TEXT,
    customer_name=TEXT,
    object_id=TEXT,
    object_address=TEXT,
    metering_point_id=LONG,
    tariff_code=TEXT,
    address_latitude=DOUBLE,
    address_longitude=DOUBLE,
    region_id=INT,
)

READINGS = _struct(
    customer_id=TEXT,
    timestamp=TIME,
    object_id=TEXT,
    metering_point_id=LONG,
    tariff_code=TEXT,
    energy_import_kwh=DOUBLE,
    energy_export_kwh=DOUBLE,
    ingested_at=TIME,
)

WEATHER = _struct(
    timestamp=TIME,
    region_id=INT,
    data_type=TEXT,
    **{v: FLOAT for v in WEATHER_VARIABLES},
    ingested_at=TIME,
)


@dataclass(frozen=True)
class TableRules:
    """What a table must satisfy; checked by ``operators.quality``."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...]
    ranges: tuple[tuple[str, float | None, float | None], ...] = ()
    optional: tuple[str, ...] = ()
    # (column, parent table, parent column)
    foreign_keys: tuple[tuple[str, str, str], ...] = ()


# Latitude -90..90, longitude 0..180, energy not below 0.
TABLES = {
    "region": TableRules(
        "region",
        REGIONS,
        ("region_id",),
        ("region_id", "center_latitude", "center_longitude"),
        (("center_latitude", -90, 90), ("center_longitude", 0, 180)),
    ),
    "customer_metadata": TableRules(
        "customer_metadata",
        METADATA,
        ("object_id",),
        tuple(METADATA.fieldNames()),
        (("address_latitude", -90, 90), ("address_longitude", 0, 180)),
        foreign_keys=(("region_id", "region", "region_id"),),
    ),
    "smart_meter": TableRules(
        "smart_meter",
        READINGS,
        ("timestamp", "object_id"),
        ("customer_id", "timestamp", "object_id", "energy_import_kwh", "energy_export_kwh", "ingested_at"),
        (("energy_import_kwh", 0, None), ("energy_export_kwh", 0, None)),
        optional=("tariff_code",),
        foreign_keys=(("object_id", "customer_metadata", "object_id"),),
    ),
    "weather": TableRules(
        "weather",
        WEATHER,
        ("timestamp", "region_id", "data_type"),
        ("timestamp", "region_id", "data_type", "ingested_at"),
        foreign_keys=(("region_id", "region", "region_id"),),
    ),
}
