"""Sources, sinks, quality checks and ingestion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterframe.operators import cleaning, continuity, quality
from meterframe.plans import ingest as ingestion
from meterframe.schemas import TABLES
from meterframe.session import fresh_path
from meterframe.sources import files, layers, prices, tables, weather_payload
from meterframe.streaming import incremental

from . import views
from .feature_checks import WEATHER_COLUMNS, T
from .registry import plain, query
from .views import READING_COLUMNS

MARK = "2024-01-20 00:00:00"
DELIVERED = f"""
    SELECT customer_id, object_id, metering_point_id, tariff_code, energy_import_kwh, energy_export_kwh,
      strftime({T}, '%d.%m.%Y %H:%M:%S') AS "timestamp" FROM doubled"""


def delivered(spark, sf) -> DataFrame:
    """Readings as text-timed rows, day first, as files bring them."""
    return views.doubled(spark, sf).select(
        "customer_id",
        F.date_format("timestamp", "dd.MM.yyyy HH:mm:ss").alias("timestamp"),
        "object_id",
        "metering_point_id",
        "tariff_code",
        "energy_import_kwh",
        "energy_export_kwh",
    )


# -- sources ----------------------------------------------------------------------


@query(
    "union_reading_files",
    f"""SELECT * REPLACE (CASE WHEN energy_export_kwh < 5 THEN NULL ELSE tariff_code END AS tariff_code)
    FROM ({DELIVERED})""",
)
def union_reading_files(spark, sf):
    """Two deliveries with other column orders, one of them without tariffs."""
    df = delivered(spark, sf)
    one, two = fresh_path(spark, "csv"), fresh_path(spark, "csv")
    low = F.col("energy_export_kwh") < 5
    df.where(~low).write.option("header", True).csv(one)
    df.where(low).drop("tariff_code").select(*reversed([c for c in df.columns if c != "tariff_code"])).write.option(
        "header", True
    ).csv(two)
    return files.read_readings(spark, [one, two])


@query("scan_dimension", "SELECT region_id, center_latitude, center_longitude FROM regions")
def scan_dimension(spark, sf):
    path = fresh_path(spark, "regions")
    views.regions(spark, sf).write.option("header", True).csv(path)
    return plain(files.read_regions(spark, path))


@query("scan_parquet_layer", "SELECT * FROM metadata")
def scan_parquet_layer(spark, sf):
    root = fresh_path(spark, "data")
    layers.write_parquet(views.metadata(spark, sf), root, "raw", "smart_meter_metadata")
    return plain(layers.load_parquet(spark, root, "RAW", "smart_meter_metadata"))


@query("parquet_round_trip", "SELECT object_id, \"timestamp\", event_id, energy_kwh FROM energy")
def parquet_round_trip(spark, sf):
    root = fresh_path(spark, "data")
    layers.write_parquet(views.energy(spark, sf), root, "processed", "energy")
    return layers.load_parquet(spark, root, "processed", "energy")


@query(
    "scan_project",
    """SELECT customer_id, customer_name, object_id, object_address, metering_point_id, tariff_code,
    address_latitude, address_longitude, region_id FROM metadata""",
)
def scan_project(spark, sf):
    return plain(tables.load_sm_metadata(views.metadata(spark, sf)))


LATER = f"SELECT * EXCLUDE (event_id) FROM readings WHERE ingested_at > TIMESTAMP '{MARK}'"


@query("incremental_scan", LATER)
def incremental_scan(spark, sf):
    return tables.load_sm_data(views.readings(spark, sf), MARK)


@query("incremental_weather", f"SELECT * FROM weather WHERE ingested_at > TIMESTAMP '{MARK}'")
def incremental_weather(spark, sf):
    return plain(tables.load_weather_data(views.weather(spark, sf), MARK), digits=None)


@query("incremental_stream", LATER)
def incremental_stream(spark, sf):
    """Two deliveries to a folder, one stream run after each."""
    source, sink, marks = (fresh_path(spark, n) for n in ("arrivals", "appended", "marks"))
    rows = views.readings(spark, sf).select(*READING_COLUMNS)
    exported = F.col("energy_export_kwh") < 5
    for delivery in (rows.where(exported), rows.where(~exported)):
        delivery.write.mode("append").parquet(source)
        stream = incremental.readings_stream(spark, source, rows.schema, MARK)
        incremental.append_new(stream, sink, marks).awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink)


VARIABLES = ("temperature_2m", "rain", "cloud_cover")
HOURLY_GRID = f"""
    SELECT d.region_id, d.day + INTERVAL (h.h) HOUR AS "timestamp",
      {", ".join(f"w.{v}" for v in VARIABLES)}
    FROM (SELECT DISTINCT region_id, date_trunc('day', {T}) AS day FROM weather_hours) d,
         (SELECT unnest(range(24)) AS h) h
    LEFT JOIN weather_hours w ON w.region_id = d.region_id AND w.{T} = d.day + INTERVAL (h.h) HOUR"""


def payloads(spark, sf) -> DataFrame:
    """One payload per region and day: 24 steps, an array per variable, start
    given in UTC with a local offset of two hours."""
    hours = views.weather_hours(spark, sf)
    day = F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("day")
    start = F.unix_date(F.to_date("day")).cast("bigint") * 86400 - 7200
    arrays = [
        F.array(*[F.max(F.when(F.hour("timestamp") == h, F.col(v))) for h in range(24)])
        .cast("array<float>")
        .alias(v)
        for v in VARIABLES
    ]
    return (
        hours.groupBy("region_id", day)
        .agg(*arrays)
        .select(
            "region_id",
            start.alias("start_epoch"),
            (start + 86400).alias("end_epoch"),
            F.lit(3600).alias("step_s"),
            F.lit(7200).alias("offset_s"),
            *VARIABLES,
        )
    )


@query("explode_hourly_payload", HOURLY_GRID)
def explode_hourly_payload(spark, sf):
    return plain(weather_payload.explode_payload(payloads(spark, sf), ["region_id"], VARIABLES), digits=None)


@query(
    "weather_by_region",
    f"""SELECT g.*, 'historical' AS data_type FROM ({HOURLY_GRID}) g""",
)
def weather_by_region(spark, sf):
    rows = weather_payload.weather_by_region(
        payloads(spark, sf), views.regions(spark, sf), "historical", "2024-01-01", "2024-01-31", variables=VARIABLES
    )
    return plain(rows, digits=None)


@query(
    "forecast_horizon_topn",
    f"""SELECT *, 48 AS horizon_hours FROM (SELECT g.*, 'forecast' AS data_type,
      min({T}) OVER (PARTITION BY region_id) AS forecast_start FROM ({HOURLY_GRID}) g
      QUALIFY row_number() OVER (PARTITION BY region_id ORDER BY {T}) <= 48)""",
)
def forecast_horizon_topn(spark, sf):
    rows = weather_payload.weather_by_region(
        payloads(spark, sf), views.regions(spark, sf), "forecast", horizon_hours=48, variables=VARIABLES
    )
    return plain(rows, digits=None)


@query(
    "write_weather_partitions",
    f"SELECT {T}, region_id, data_type, {WEATHER_COLUMNS}, ingested_at FROM weather",
)
def write_weather_partitions(spark, sf):
    path = weather_payload.write_weather(views.weather(spark, sf), fresh_path(spark, "weather"))
    return plain(spark.read.parquet(path).drop("forecast_start", "horizon_hours"), digits=None)


@query(
    "price_rows_clean",
    """SELECT event_id, strftime(ts, '%H:%M') AS delivery_period, value AS "price_EUR_MWh"
    FROM events WHERE event_type NOT IN ('error', 'click')""",
)
def price_rows_clean(spark, sf):
    """Each event as a table row: errors have no number, clicks a third cell."""
    cell = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.regexp_replace(F.col("value").cast("string"), r"\.", ",")
    )
    third = F.when(F.col("event_type") == "click", "<td>+</td>").otherwise("")
    row = F.concat(
        F.lit('<tr class="row"><td> '),
        F.date_format("ts", "HH:mm"),
        F.lit(' </td>\n<td align="right"> <b>'),
        cell,
        F.lit("</b> </td>"),
        third,
        F.lit("</tr>"),
    )
    df = views.table(spark, sf, "events").select("event_id", row.alias("row_html"))
    return prices.clean_price_rows(df, keep=("event_id",))


# -- sinks --------------------------------------------------------------------------


@query(
    "export_raw_layer",
    f"""SELECT 'readings' AS layer, strftime({T}, '%Y-%m') AS "month", count(*) AS "rows" FROM readings GROUP BY ALL
    UNION ALL SELECT 'weather', strftime({T}, '%Y-%m'), count(*) FROM weather GROUP BY ALL
    UNION ALL SELECT 'metadata', NULL, count(*) FROM metadata""",
)
def export_raw_layer(spark, sf):
    root = fresh_path(spark, "data")
    paths = layers.export_raw_layer(
        root,
        views.metadata(spark, sf),
        views.readings(spark, sf).select(*READING_COLUMNS),
        views.weather(spark, sf),
    )
    named = {"metadata": "smart_meter_metadata", "readings": "smart_meter_readings", "weather": "weather"}
    counted = []
    for label, dataset in named.items():
        df = spark.read.parquet(paths[dataset])
        month = F.col("month") if "month" in df.columns else F.lit(None).cast("string")
        counted.append(
            df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("rows")).withColumn("layer", F.lit(label))
        )
    return reduce(DataFrame.unionByName, counted)


@query(
    "export_raw_readings",
    f"""SELECT {", ".join(f'"{c}"' for c in READING_COLUMNS)}, strftime({T}, '%Y-%m') AS "month" FROM readings""",
)
def export_raw_readings(spark, sf):
    """The rows of the exported readings, with the folder they lie in."""
    paths = layers.export_raw_layer(
        fresh_path(spark, "data"), views.metadata(spark, sf), views.readings(spark, sf).select(*READING_COLUMNS), views.weather(spark, sf)
    )
    return plain(spark.read.parquet(paths["smart_meter_readings"]), digits=None)


def _table_names(spark):
    where = fresh_path(spark, "tables")
    prefix = f"t{where.rsplit('-', 1)[1]}_"
    tables.create_raw_tables(spark, where, prefix)
    tables.create_raw_tables(spark, where, prefix)  # a second call changes nothing
    return prefix


TWICE = "SELECT *, 2 AS copies FROM (SELECT * EXCLUDE (event_id) FROM readings)"


@query("append_table", TWICE)
def append_table(spark, sf):
    name = _table_names(spark) + tables.TABLE_NAMES["smart_meter"]
    rows = views.readings(spark, sf)
    for _ in range(2):
        tables.load_dataframe(rows, name)
    return spark.table(name).groupBy(*READING_COLUMNS).agg(F.count(F.lit(1)).alias("copies"))


@query("reload_table", "SELECT * FROM metadata")
def reload_table(spark, sf):
    """Regions are emptied, which empties metadata; then metadata comes back."""
    prefix = _table_names(spark)
    name = prefix + tables.TABLE_NAMES["customer_metadata"]
    rows = views.metadata(spark, sf)
    tables.load_dataframe(rows, name)
    tables.truncate_table(spark, "region", prefix)
    tables.load_dataframe(rows, name, if_exists="fail")
    tables.load_dataframe(rows, name, if_exists="replace")
    return plain(spark.table(name))


# -- cleaning and quality --------------------------------------------------------------


@query("parse_timestamps", f'SELECT * FROM (SELECT * EXCLUDE (ingested_at, event_id) FROM doubled)')
def parse_timestamps(spark, sf):
    return cleaning.timestamp_to_datetime(delivered(spark, sf))


@query(
    "duplicate_stats",
    f"""SELECT count(*) AS duplicate_groups, coalesce(sum(n), 0)::BIGINT AS duplicate_rows
    FROM (SELECT count(*) AS n FROM doubled GROUP BY object_id, {T} HAVING count(*) > 1)""",
)
def duplicate_stats(spark, sf):
    return quality.duplicate_stats(views.doubled(spark, sf), "object_id")


IMPORT = "CAST(sum(CAST(round(energy_import_kwh * 100) AS BIGINT)) AS DOUBLE) / 100"
EXPORT = "CAST(sum(CAST(round(energy_export_kwh * 10) AS BIGINT)) AS DOUBLE) / 10"
MERGING = f"extract('month' FROM {T}) = 10 AND extract('day' FROM {T}) BETWEEN 25 AND 30"


def _merged(key: str) -> str:
    def first(c):
        return f"first({c} ORDER BY event_id) FILTER (WHERE {c} IS NOT NULL) AS {c}"

    others = [c for c in ("customer_id", "object_id") if c != key]
    rest = ", ".join(first(c) for c in [*others, "metering_point_id", "tariff_code", "ingested_at", "event_id"])
    return f"""SELECT {key}, {T}, round({IMPORT}, 6) AS energy_import_kwh, round({EXPORT}, 6) AS energy_export_kwh,
      {rest} FROM doubled WHERE {MERGING} GROUP BY {key}, {T}"""


def _kept(key: str) -> str:
    return f"""SELECT * FROM doubled WHERE NOT ({MERGING})
    QUALIFY row_number() OVER (PARTITION BY {key}, {T} ORDER BY event_id) = 1"""


def _rest(df):
    return df.where(~cleaning.clock_change_days())


@query("merge_duplicates_sum", _merged("object_id"))
def merge_duplicates_sum(spark, sf):
    df = views.doubled(spark, sf).where(cleaning.clock_change_days())
    return plain(
        cleaning.merge_sum(
            df, ["object_id", "timestamp"], ["energy_import_kwh", "energy_export_kwh"], ["event_id"]
        )
    )


@query("dedupe_keep_first", _kept("object_id"))
def dedupe_keep_first(spark, sf):
    return cleaning.keep_first(_rest(views.doubled(spark, sf)), ["object_id", "timestamp"], ["event_id"])


@query("canonicalize_readings", f"SELECT * FROM ({_merged('object_id')}) UNION ALL BY NAME SELECT * FROM ({_kept('object_id')})")
def canonicalize_readings(spark, sf):
    return plain(cleaning.handle_duplicates(views.doubled(spark, sf), "smart_meter", ties=["event_id"]))


@query(
    "canonicalize_by_customer",
    f"SELECT * FROM ({_merged('customer_id')}) UNION ALL BY NAME SELECT * FROM ({_kept('customer_id')})",
)
def canonicalize_by_customer(spark, sf):
    return plain(
        cleaning.handle_duplicates(views.doubled(spark, sf), "smart_meter", key="customer_id", ties=["event_id"])
    )


@query(
    "dedupe_weather",
    f"SELECT {T}, region_id, data_type, {WEATHER_COLUMNS}, ingested_at FROM weather WHERE data_type = 'forecast'",
)
def dedupe_weather(spark, sf):
    return plain(cleaning.handle_duplicates(views.weather(spark, sf), "weather", ties=["data_type"]), digits=None)


CONTINUITY = f"""
    SELECT {{key}}, count(*) FILTER (WHERE h IS NULL OR h <= {{step}}) AS ok,
      count(*) FILTER (WHERE h > {{step}}) AS gap, 0::BIGINT AS time_reversal
    FROM (SELECT {{key}}, epoch({T} - lag({T}) OVER (PARTITION BY {{key}} ORDER BY {T})) / 3600 AS h FROM {{source}})
    GROUP BY {{key}}"""


@query("time_continuity", CONTINUITY.format(key="object_id", source="readings", step=1))
def time_continuity(spark, sf):
    return quality.time_continuity(views.readings(spark, sf), ties=["event_id"])


@query("time_continuity_regions", CONTINUITY.format(key="region_id", source="weather_hours", step=2))
def time_continuity_regions(spark, sf):
    return plain(
        quality.time_continuity(views.weather_hours(spark, sf), "region_id", expected_step_hours=2)
    )


@query("hot_series_continuity", CONTINUITY.format(key="object_id", source="readings", step=12))
def hot_series_continuity(spark, sf):
    return quality.time_continuity(
        views.readings(spark, sf), ties=["event_id"], expected_step_hours=12, part_rows=8
    )


@query("continuity_runs", CONTINUITY.format(key="object_id", source="readings", step=1))
def continuity_by_runs(spark, sf):
    return continuity.continuity_runs(views.readings(spark, sf))


@query("continuity_runs_steps", CONTINUITY.format(key="object_id", source="doubled", step=6))
def continuity_runs_steps(spark, sf):
    """Hours that occur several times, and gaps of up to six hours allowed."""
    return continuity.continuity_runs(views.doubled(spark, sf), expected_step_hours=6)


@query("stamp_ingestion", 'SELECT * REPLACE ("timestamp" AS ingested_at) FROM doubled')
def stamp_ingestion(spark, sf):
    return cleaning.add_ingestion_time(views.doubled(spark, sf), "smart_meter_backtest")


def _frames(spark, sf):
    return {
        "region": views.regions(spark, sf),
        "customer_metadata": views.metadata(spark, sf),
        "smart_meter": views.doubled(spark, sf),
        "weather": views.weather(spark, sf),
    }


SOURCES = {"region": "regions", "customer_metadata": "metadata", "smart_meter": "doubled", "weather": "weather"}


def _rule_sql(table: str, source: str) -> list[str]:
    rules = TABLES[table]
    out = [f"SELECT '{table}' AS table_name, '{c} not null' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {source}"
           for c in rules.not_null]
    for c, low, high in rules.ranges:
        for sign, bound, broken in ((">=", low, "<"), ("<=", high, ">")):
            if bound is not None:
                out.append(f"SELECT '{table}', '{c} {sign} {bound}', count(*) FILTER (WHERE {c} {broken} {bound}) FROM {source}")
    return out


def _quoted(sql: str) -> str:
    """The column timestamp in quotes, but not the rule named after it."""
    return sql.replace("(WHERE timestamp", f"(WHERE {T}")


# Balances stand in for readings here, since some of them are below zero.
@query(
    "schema_violations",
    " UNION ALL ".join(
        [_quoted(s) for t, source in SOURCES.items() for s in _rule_sql(t, source)]
        + ["""SELECT 'accounts', 'energy_import_kwh >= 0', count(*) FILTER (WHERE c_acctbal < 0) FROM customer"""]
    ),
)
def schema_violations(spark, sf):
    found = [quality.schema_violations(df, t) for t, df in _frames(spark, sf).items()]
    accounts = views.table(spark, sf, "customer").select(F.col("c_acctbal").alias("energy_import_kwh"))
    found.append(
        quality.schema_violations(accounts, "smart_meter")
        .where("rule = 'energy_import_kwh >= 0'")
        .withColumn("table_name", F.lit("accounts"))
    )
    return reduce(DataFrame.unionByName, found)


# Readings without a tariff stand in for metadata that lacks it.
@query(
    "not_null_violations",
    " UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, '{c}' AS rule, count(*) FILTER (WHERE \"{c}\" IS NULL) AS violations FROM {source}"
         for t, source in SOURCES.items() for c in TABLES[t].not_null]
        + [f"SELECT 'tariffs of readings', '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM readings" for c in ("object_id", "tariff_code")]
    ),
)
def not_null_violations(spark, sf):
    found = [quality.not_null_violations(df, t) for t, df in _frames(spark, sf).items()]
    rows = views.readings(spark, sf)
    rules = [quality._rule(c, F.col(c).isNull()) for c in ("object_id", "tariff_code")]
    found.append(quality._report(rows, "tariffs of readings", rules))
    return reduce(DataFrame.unionByName, found)


@query(
    "pk_violations",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
        coalesce(sum(n - 1), 0)::BIGINT AS extra_rows
        FROM (SELECT count(*) AS n FROM {source} GROUP BY {", ".join(f'"{k}"' for k in TABLES[t].primary_key)})"""
        for t, source in SOURCES.items()
    ),
)
def pk_violations(spark, sf):
    found = [quality.pk_violations(df, t) for t, df in _frames(spark, sf).items()]
    return reduce(DataFrame.unionByName, found)


# Meters outside one market segment have moved ids in the metadata, so their
# readings are orphans.
@query(
    "fk_violations",
    """WITH known AS (SELECT CASE WHEN tariff_code = 'BUILDING' THEN object_id ELSE 'moved ' || object_id END AS object_id FROM metadata),
      orphans AS (SELECT object_id, count(*) AS n FROM doubled
                  WHERE object_id NOT IN (SELECT object_id FROM known) GROUP BY 1)
    SELECT 'customer_metadata.region_id -> region' AS foreign_key, 0 AS missing_keys, 0 AS orphan_rows
    UNION ALL SELECT 'smart_meter.object_id -> customer_metadata', count(*), coalesce(sum(n), 0)::BIGINT FROM orphans
    UNION ALL SELECT 'weather.region_id -> region', 0, 0""",
)
def fk_violations(spark, sf):
    frames = _frames(spark, sf)
    moved = F.when(F.col("tariff_code") == "BUILDING", F.col("object_id")).otherwise(F.concat(F.lit("moved "), "object_id"))
    frames["customer_metadata"] = frames["customer_metadata"].withColumn("object_id", moved)
    return quality.fk_violations(frames)


@query(
    "time_continuity_weather_types",
    f"""SELECT region_id || ' ' || data_type AS series, count(*) FILTER (WHERE h IS NULL OR h BETWEEN 0 AND 1) AS ok,
      count(*) FILTER (WHERE h > 1) AS gap, count(*) FILTER (WHERE h < 0) AS time_reversal
    FROM (SELECT region_id, data_type, epoch({T} - lag({T}) OVER (PARTITION BY region_id, data_type ORDER BY {T})) / 3600 AS h FROM weather)
    GROUP BY ALL""",
)
def time_continuity_weather_types(spark, sf):
    """Each kind of weather is a series of its own."""
    rows = views.weather(spark, sf).withColumn("series", F.concat_ws(" ", F.col("region_id").cast("string"), "data_type"))
    return quality.time_continuity(rows, "series")


# -- ingestion --------------------------------------------------------------------------


CLEAN = f"""
    SELECT * EXCLUDE (event_id, ingested_at), {T} AS ingested_at FROM
      (SELECT * FROM ({_merged('object_id')}) UNION ALL BY NAME SELECT * FROM ({_kept('object_id')}))"""


def _ingested(spark, sf):
    # Readings keep their event number as the order of arrival.
    rows = views.doubled(spark, sf).withColumn("timestamp", F.date_format("timestamp", "dd.MM.yyyy HH:mm:ss"))
    moved = views.weather(spark, sf)
    return ingestion.ingest(
        rows.drop("ingested_at"),
        views.metadata(spark, sf),
        views.regions(spark, sf),
        moved,
        ties=["event_id"],
        strict=False,
    )


@query("ingest_run", CLEAN)
def ingest_run(spark, sf):
    done = _ingested(spark, sf)
    name = _table_names(spark) + tables.TABLE_NAMES["smart_meter"]
    tables.load_dataframe(done.readings, name)
    return plain(tables.load_sm_data(spark.table(name)))


def _gaps_sql(table: str, key: str, source: str) -> str:
    return f"""SELECT '{table}', 'gaps', count(*) FILTER (WHERE h > 1) FROM (
      SELECT epoch({T} - lag({T}) OVER (PARTITION BY {key} ORDER BY {T})) / 3600 AS h FROM {source})"""


def _report_sql() -> str:
    checked = {**SOURCES, "smart_meter": "clean", "weather": "weather"}
    lines = [_quoted(s) for t, source in checked.items() for s in _rule_sql(t, source)]
    for t, rules in TABLES.items():
        keys = ", ".join(f'"{k}"' for k in rules.primary_key)
        lines.append(f"SELECT '{t}', 'duplicate keys', count(*) FROM (SELECT 1 FROM {checked[t]} GROUP BY {keys} HAVING count(*) > 1)")
        lines += [
            f"SELECT '{t}', '{t}.{column} -> {parent}', count(*) FROM {checked[t]} c "
            f"WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {checked[parent]} p WHERE p.{key} = c.{column})"
            for column, parent, key in rules.foreign_keys
        ]
    lines += [_gaps_sql("smart_meter", "object_id", "clean"), _gaps_sql("weather", "region_id, data_type", "weather")]
    report = " UNION ALL ".join(lines).replace("AS rule", "AS check_name").replace("AS violations", "AS value")
    return f"""WITH clean AS ({CLEAN}) {report}"""


@query("ingest_report", _report_sql())
def ingest_report(spark, sf):
    return _ingested(spark, sf).report

