"""Calendar, encoding, splits, weather and the whole feature table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from meterframe.functions.rounding import quantize_half as half
from meterframe.operators import calendar, directions, encode, splits, weather
from meterframe.operators.cleaning import null_counts
from meterframe.plans import features

from . import views
from .history_checks import HOUR_KEY, IDS, KEY, MEAN, ODD, STD, full
from .registry import plain, query, rounded
from .views import BOUNDS, HOURLY, ORDER

T = '"timestamp"'


def _range(name: str) -> str:
    low, high = BOUNDS[name]
    return f"{T} >= TIMESTAMP '{low}' AND {T} < TIMESTAMP '{high}'"


def _cycle(name: str, expr: str, period: int) -> str:
    # + 0 turns a rounded -0 into 0
    return (
        f"{expr} AS {name}, round(sin(2 * pi() * {expr} / {period}), 6) + 0 AS {name}_sin, "
        f"round(cos(2 * pi() * {expr} / {period}), 6) + 0 AS {name}_cos"
    )


HOURS = _cycle("hour", f"extract('hour' FROM {T})", 24)
WEEKS = _cycle("week", f"extract('week' FROM {T})", 52)
MONTHS = _cycle("month", f"extract('month' FROM {T})", 12)
DAYS = f"extract('day' FROM {T}) AS day"
WEEKDAYS = f"extract('isodow' FROM {T}) - 1 AS weekday, extract('isodow' FROM {T}) IN (6, 7) AS is_weekend"
HOLIDAYS = (
    f"strftime({T}, '%m-%d') IN ('01-01', '05-01', '06-23', '06-24', '11-18', '12-24', '12-25', '12-26') "
    "AS is_holiday"
)
# Ship dates span years, so weeks 52 and 53, all months and holidays occur.
SHIPPED = f'SELECT l_orderkey, l_linenumber, l_shipdate AS {T} FROM lineitem'


def _shipped(spark, sf):
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("timestamp")
    )


def _calendar(name, fn, columns, source=SHIPPED, frame=_shipped):
    @query(name, f"SELECT *, {columns} FROM ({source})")
    def run(spark, sf):
        return plain(fn(frame(spark, sf)))


def _energy(spark, sf):
    return views.energy(spark, sf).drop("energy_kwh")


_calendar("cal_hours", calendar.add_hours, HOURS, f"SELECT {IDS} FROM energy", _energy)
_calendar("cal_day", calendar.add_dates, DAYS)
_calendar("cal_weekday", lambda df: calendar.add_weekdays(df, weekends=True), WEEKDAYS)
_calendar("cal_week", calendar.add_weeks, WEEKS)
_calendar("cal_month", calendar.add_months, MONTHS)
_calendar("cal_holiday", calendar.add_holidays, HOLIDAYS)
_calendar(
    "calendar_features",
    calendar.add_calendar_features,
    ", ".join([HOURS, DAYS, WEEKDAYS, HOLIDAYS, WEEKS, MONTHS]),
)


@query(
    "bool_to_tinyint",
    f"SELECT {IDS}, CAST(energy_kwh > 20 AS BIGINT) AS is_high, energy_kwh FROM energy",
)
def bool_to_tinyint(spark, sf):
    df = views.energy(spark, sf).withColumn("is_high", F.col("energy_kwh") > 20)
    return plain(encode.normalize_bool_columns(df))


@query(
    "one_hot",
    f"""SELECT {IDS}, extract('hour' FROM {T}) AS hour, tariff_code,
      {", ".join(f"CAST(extract('hour' FROM {T}) = {h} AS BIGINT) AS hour_{h}" for h in range(24))},
      {", ".join(f"coalesce(CAST(tariff_code = '{t}' AS BIGINT), 0) AS tariff_code_{t}"
                 for t in ("click", "purchase", "signup", "view"))}
    FROM readings""",
)
def one_hot(spark, sf):
    df = views.readings(spark, sf).select(
        "object_id", "timestamp", "event_id", F.hour("timestamp").alias("hour"), "tariff_code"
    )
    return plain(encode.one_hot(df, ["hour", "tariff_code"]))


# As many values as orders: far more than a table can have columns.
SPARSE = "CASE WHEN l_orderkey % 7 = 3 THEN NULL ELSE 'order ' || CAST(l_orderkey AS VARCHAR) END"


@query(
    "one_hot_sparse",
    f"""WITH rows_ AS (SELECT l_orderkey, l_linenumber, l_suppkey, {SPARSE} AS label FROM lineitem),
      labels_ AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM rows_ WHERE label IS NOT NULL)),
      known AS (SELECT l_suppkey, row_number() OVER (ORDER BY l_suppkey) - 1 AS code
                FROM (SELECT DISTINCT l_suppkey FROM rows_ WHERE l_linenumber = 1 AND l_suppkey % 5 > 0))
    SELECT l_orderkey, l_linenumber, r.l_suppkey, r.label, l.code AS label_index, CAST(l.code IS NOT NULL AS BIGINT) AS label_value,
      k.code AS l_suppkey_index, CAST(k.code IS NOT NULL AS BIGINT) AS l_suppkey_value
    FROM rows_ r LEFT JOIN labels_ l ON r.label = l.label LEFT JOIN known k ON r.l_suppkey = k.l_suppkey""",
)
def one_hot_sparse(spark, sf):
    """Labels by their own codes; suppliers by those of some rows."""
    label = F.when(F.col("l_orderkey") % 7 != 3, F.concat(F.lit("order "), F.col("l_orderkey").cast("string")))
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", label.alias("label"))
    known = encode.category_codes(rows.where("l_linenumber = 1 AND l_suppkey % 5 > 0"), "l_suppkey")
    return plain(encode.one_hot_sparse(rows, ["label", "l_suppkey"], {"l_suppkey": known}))


def _measures(spark, sf):
    return views.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax"
    )


@query(
    "zscore_fit",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM lineitem"
        for c in ("l_quantity", "l_extendedprice")
    ),
)
def zscore_fit(spark, sf):
    return plain(encode.fit_zscore(_measures(spark, sf), exclude=("l_tax",)))


@query(
    "zscore_apply",
    f"""SELECT l_orderkey, l_linenumber, l_tax,
      {", ".join(f"round(({c} - m_{c}) / s_{c}, 6) + 0 AS {c}" for c in ("l_quantity", "l_extendedprice"))}
    FROM lineitem, (SELECT
      {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in ("l_quantity", "l_extendedprice"))}
      FROM lineitem)""",
)
def zscore_apply(spark, sf):
    scaled, _ = encode.zscore_scale_float_columns(_measures(spark, sf), exclude=("l_tax",))
    return plain(scaled)


@query(
    "downcast_float32",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS l_extendedprice,
      CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) AS l_quantity, l_tax FROM lineitem""",
)
def downcast_float32(spark, sf):
    return plain(encode.downcast_floats(_measures(spark, sf), exclude=("l_tax",)), digits=None)


def _half_sql(column: str) -> str:
    step = f"pow(2.0::DOUBLE, greatest(floor(log2(nullif(abs({column}), 0))), -14) - 10)"
    return f"""CASE WHEN (SELECT max(abs({column})) FROM lineitem) > 65504 THEN CAST(CAST({column} AS FLOAT) AS DOUBLE)
      WHEN {column} = 0 THEN 0 ELSE round_even({column} / {step}, 0) * {step} END AS {column}"""


@query(
    "downcast_half",
    f"SELECT l_orderkey, l_linenumber, {_half_sql('l_extendedprice')}, {_half_sql('l_quantity')}, l_tax FROM lineitem",
)
def downcast_half(spark, sf):
    """Half precision where all values of a column fit it, else FLOAT."""
    return plain(encode.downcast_floats(_measures(spark, sf), exclude=("l_tax",), half=True), digits=None)


@query(
    "quantize_half",
    f"""SELECT {IDS}, energy_kwh,
      CASE WHEN energy_kwh = 0 THEN 0
           ELSE round_even(energy_kwh / step, 0) * step END AS half_kwh
    FROM (SELECT *, pow(2.0::DOUBLE, greatest(floor(log2(nullif(abs(energy_kwh), 0))), -14) - 10) AS step FROM energy)""",
)
def quantize_half(spark, sf):
    return views.energy(spark, sf).withColumn("half_kwh", half(F.col("energy_kwh")))


@query("select_rename", f'SELECT {T}, object_id, energy_import_kwh AS energy_kwh FROM readings')
def select_rename(spark, sf):
    return features.select_target(views.readings(spark, sf))


@query("filter_isin", "SELECT * EXCLUDE (event_id) FROM readings WHERE tariff_code IN ('click', 'purchase')")
def filter_isin(spark, sf):
    return splits.filter_members(views.readings(spark, sf).drop("event_id"), "tariff_code", ["click", "purchase"])


@query("filter_time_range", f"SELECT {IDS}, energy_kwh FROM energy WHERE {_range('dev')}")
def filter_time_range(spark, sf):
    return splits.filter_time_range(views.energy(spark, sf), *BOUNDS["dev"])


SPLIT = (
    f"CASE WHEN {_range('train')} THEN 'train' WHEN {_range('dev')} THEN 'dev' "
    f"WHEN {_range('test')} THEN 'test' END"
)
ASSIGNED = f"SELECT * FROM (SELECT {IDS}, energy_kwh, {SPLIT} AS split FROM energy) WHERE split IS NOT NULL"


@query("assign_split", ASSIGNED)
def assign_split(spark, sf):
    return splits.assign_split(views.energy(spark, sf), BOUNDS)


@query(
    "split_coverage",
    f'SELECT split, count(*) AS "rows", min({T}) AS first_time, max({T}) AS last_time FROM ({ASSIGNED}) GROUP BY split',
)
def split_coverage(spark, sf):
    return splits.split_coverage(splits.assign_split(views.energy(spark, sf), BOUNDS))


@query("write_splits", ASSIGNED)
def write_splits(spark, sf):
    return splits.scratch_splits(splits.assign_split(views.energy(spark, sf), BOUNDS))


# Each order priority's date range per order status as bounds; the dates of
# the three statuses overlap.
@query(
    "split_bounds_check",
    """WITH bounds AS (SELECT o_custkey, o_orderstatus AS split, min(o_orderdate) AS low, max(o_orderdate) AS high
                       FROM orders GROUP BY ALL)
    SELECT o_custkey, split, "empty", "overlaps" FROM (
      SELECT *, low >= high AS "empty",
        coalesce(low < lag(high) OVER (PARTITION BY o_custkey ORDER BY low, split), FALSE) AS "overlaps" FROM bounds)
    WHERE "overlaps" OR "empty" """,
)
def split_bounds_check(spark, sf):
    bounds = (
        views.table(spark, sf, "orders")
        .groupBy("o_custkey", F.col("o_orderstatus").alias("split"))
        .agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    )
    return splits.split_bounds_violations(bounds, "o_custkey")


def _two_ways(spark, sf):
    from meterframe.operators import history

    df = views.readings(spark, sf).select(
        "object_id", "timestamp", "event_id", "energy_import_kwh", "energy_export_kwh"
    )
    return history.add_lags(df, (1,), order=ORDER)


@query(
    "split_by_direction",
    " UNION ALL ".join(
        f"""SELECT {IDS}, energy_{d}_kwh AS energy_kwh, lag(energy_{d}_kwh, 1) OVER ({KEY}) AS lagged_1_energy_kwh,
        '{d}' AS direction FROM readings"""
        for d in ("import", "export")
    ),
)
def split_by_direction(spark, sf):
    return directions.stack_directions(_two_ways(spark, sf))


@query(
    "join_region",
    f"SELECT e.object_id, {T}, event_id, energy_kwh, region_id FROM energy e LEFT JOIN metadata m ON e.object_id = m.object_id",
)
def join_region(spark, sf):
    return plain(weather.join_region(views.energy(spark, sf), views.metadata(spark, sf)))


WEATHER_COLUMNS = (
    "temperature_2m, rain, snowfall, cloud_cover, weather_code, is_day, wind_speed_10m, "
    "relative_humidity_2m, apparent_temperature, precipitation"
)


def _weather_sql(kind: str) -> str:
    return f"""SELECT h.object_id, h.{T}, energy_import_kwh, m.region_id, {WEATHER_COLUMNS}, data_type
    FROM hourly h LEFT JOIN metadata m ON h.object_id = m.object_id
    LEFT JOIN (SELECT * FROM weather WHERE {kind}) w ON w.{T} = h.{T} AND w.region_id = m.region_id"""


def _joined(spark, sf, data_type):
    rows = views.weather(spark, sf).drop("ingested_at")
    return plain(
        weather.join_weather(views.hourly(spark, sf), views.metadata(spark, sf), rows, data_type), digits=None
    )


@query("join_weather", _weather_sql("data_type = 'historical'"))
def join_weather(spark, sf):
    return _joined(spark, sf, "historical")


@query("join_weather_fanout", _weather_sql("TRUE"))
def join_weather_fanout(spark, sf):
    return _joined(spark, sf, None)


@query(
    "null_summary",
    """SELECT 'tariff_code' AS column_name, count(*) - count(tariff_code) AS nulls FROM readings
    HAVING count(*) > count(tariff_code)""",
)
def null_summary(spark, sf):
    return null_counts(views.readings(spark, sf))


# -- the whole table ------------------------------------------------------------

PLAN = features.FeaturePlan(
    lags=(1, 6, 12, 24, 168), average_days=(30, 90), digits=2, order=HOURLY
)
FROZEN = [f"rolling_{a}_energy_kwh_{n}" for n in PLAN.windows for a in PLAN.aggs] + [
    f"lagged_{n}_energy_kwh" for n in PLAN.lags
]


def _table_sql() -> str:
    rolling = ", ".join(
        f"{full(sql, n, HOUR_KEY)} AS rolling_{name}_energy_kwh_{n}"
        for n in PLAN.windows
        for name, sql in (("mean", MEAN), ("std", STD))
    )
    lags = ", ".join(f"lag(energy_kwh, {n}) OVER ({HOUR_KEY}) AS lagged_{n}_energy_kwh" for n in PLAN.lags)
    averages = ", ".join(
        f"CAST(sum(cents) OVER ({HOUR_KEY} ROWS BETWEEN {start} PRECEDING AND 24 PRECEDING) AS DOUBLE) / "
        f"nullif(count(cents) OVER ({HOUR_KEY} ROWS BETWEEN {start} PRECEDING AND 24 PRECEDING), 0) / 100 AS {name}"
        for start, name in [
            ("UNBOUNDED", "customer_mean_energy_kwh"),
            *[(d * 24 + 23, f"customer_{d}d_mean_energy_kwh") for d in PLAN.average_days],
        ]
    )
    block = f"(PARTITION BY object_id, block ORDER BY {T})"
    frozen = ", ".join(f"first_value({c}) OVER {block} AS {c}_frozen" for c in FROZEN)
    flags = WEEKDAYS.replace(
        f"extract('isodow' FROM {T}) IN (6, 7)", f"CAST(extract('isodow' FROM {T}) IN (6, 7) AS BIGINT)"
    )
    holidays = HOLIDAYS.replace("strftime", "CAST(strftime").replace(" AS is_holiday", " AS BIGINT) AS is_holiday")
    hot = ", ".join(
        [f"CAST(weekday = {d} AS BIGINT) AS weekday_{d}" for d in range(7)]
        + [f"CAST(hour = {h} AS BIGINT) AS hour_{h}" for h in range(24)]
    )
    return f"""
    SELECT *, {hot} FROM (
      SELECT * EXCLUDE (rn, block, cents), {frozen},
        first_value({T}) OVER {block} - INTERVAL 1 HOUR AS forecast_origin_time,
        {HOURS}, {DAYS}, {flags}, {holidays}, {WEEKS}, {MONTHS}, {SPLIT} AS split
      FROM (SELECT *, (rn - 1) // 24 AS block FROM (
        SELECT object_id, {T}, energy_kwh, cents, region_id, {WEATHER_COLUMNS},
          row_number() OVER ({HOUR_KEY}) AS rn, {rolling}, {lags}, {averages}
        FROM (SELECT h.object_id, h.{T}, energy_import_kwh AS energy_kwh,
                CAST(round(energy_import_kwh * 100) AS HUGEINT) AS cents, m.region_id, {WEATHER_COLUMNS}
              FROM hourly h LEFT JOIN metadata m ON h.object_id = m.object_id
              LEFT JOIN weather_hours w ON w.{T} = h.{T} AND w.region_id = m.region_id))))
    WHERE split IS NOT NULL"""


TABLE = _table_sql()


def _comparable(df):
    """Only sines and cosines are rounded; all else is exact in both engines."""
    cycles = [c for c in df.columns if c.endswith(("_sin", "_cos"))]
    return plain(df.withColumns({c: rounded(F.col(c), 6) for c in cycles}), digits=None)


def _table(spark, sf, plan, metadata_copies=1, weather_copies=1):
    metadata, hours = views.metadata(spark, sf), views.weather(spark, sf)
    if metadata_copies == 2:
        metadata = metadata.unionAll(metadata)
    if weather_copies == 2:
        hours = hours.unionAll(hours)
    built = features.build_features(views.hourly(spark, sf), metadata, hours, plan)
    return _comparable(splits.assign_split(built, BOUNDS))


# A dimension row that occurs twice gives each finished row twice; the past of a
# meter is what it was.
@query("build_features_duplicate_metadata", f"SELECT t.* FROM ({TABLE}) t, range(2)")
def build_features_duplicate_metadata(spark, sf):
    return _table(spark, sf, PLAN, metadata_copies=2)


# Hours without weather stay single rows.
@query(
    "build_features_duplicate_weather",
    f"""SELECT t.* FROM ({TABLE}) t
    UNION ALL SELECT t.* FROM ({TABLE}) t JOIN weather_hours w ON w.{T} = t.{T} AND w.region_id = t.region_id""",
)
def build_features_duplicate_weather(spark, sf):
    return _table(spark, sf, PLAN, weather_copies=2)


@query("build_features", TABLE)
def build_features(spark, sf):
    return _table(spark, sf, PLAN)


ROUGH = [*FROZEN[: -len(PLAN.lags)], *[f"{c}_frozen" for c in FROZEN[: -len(PLAN.lags)]], "customer_mean_energy_kwh", *[f"customer_{d}d_mean_energy_kwh" for d in PLAN.average_days]]


@query("build_features_any_digits", f"SELECT * REPLACE ({', '.join(f'round({c} * {ODD}::DOUBLE, 6) AS {c}' for c in ROUGH)}) FROM ({TABLE})")
def build_features_any_digits(spark, sf):
    """The plan as it is by default: readings with digits of any number."""
    made = _table(spark, sf, replace(PLAN, digits=None))
    return made.withColumns({c: rounded(F.col(c) * ODD, 6) for c in ROUGH})


@query(
    "model_run_stored_splits",
    f"""SELECT object_id, TRUE AS scored, count(*) AS forecasts FROM ({TABLE})
    WHERE split = 'test' AND object_id IN (SELECT object_id FROM ({TABLE}) WHERE split = 'train') GROUP BY object_id""",
)
def model_run_stored_splits(spark, sf):
    """The model run on the written feature table, with all its features."""
    from meterframe.plans.ledger import read_runs
    from meterframe.plans.runs import model_run
    from meterframe.session import fresh_path

    path = features.make_splits(
        views.hourly(spark, sf), views.metadata(spark, sf), views.weather(spark, sf), BOUNDS, fresh_path(spark, "features"), PLAN
    )
    train, test = (spark.read.parquet(path).where(F.col("split") == n) for n in ("train", "test"))
    run = model_run(train, test, features.model_features(train), fresh_path(spark, "ledger"), order=HOURLY)
    per_meter = run.forecasts.groupBy("object_id").agg(F.count_if(F.abs("y_pred") < float("inf")).alias("forecasts"))
    return per_meter.join(run.per_customer, "object_id").select("object_id", (F.col("MAE") >= 0).alias("scored"), "forecasts")


@query("make_splits", TABLE)
def make_splits(spark, sf):
    from meterframe.session import fresh_path

    path = features.make_splits(
        views.hourly(spark, sf),
        views.metadata(spark, sf),
        views.weather(spark, sf),
        BOUNDS,
        fresh_path(spark, "features"),
        PLAN,
    )
    return _comparable(spark.read.parquet(path))
