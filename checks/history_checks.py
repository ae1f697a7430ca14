"""History features (lags, rolling, frozen, long averages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterframe.operators import cleaning, history
from meterframe.operators.series import SeriesParts

from . import views
from .registry import plain, query, rounded
from .views import HOURLY, ORDER

KEY = 'PARTITION BY object_id ORDER BY "timestamp", event_id'
HOUR_KEY = 'PARTITION BY object_id ORDER BY "timestamp"'
IDS = 'object_id, "timestamp", event_id'


def full(value: str, n: int, key: str = KEY, column: str = "energy_kwh") -> str:
    """``value`` over the n rows before, null unless n values are there."""
    frame = f"({key} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({column}) OVER {frame} = {n} THEN {value.format(f=frame, n=n)} END"


MEAN = "CAST(sum(cents) OVER {f} AS DOUBLE) / {n} / 100"
SUM = "CAST(sum(cents) OVER {f} AS DOUBLE) / 100"
SCATTER = "CAST({n} * sum(cents * cents) OVER {f} - sum(cents) OVER {f} * sum(cents) OVER {f} AS DOUBLE)"
VAR = SCATTER + " / ({n} * ({n} - 1)) / 10000"
STD = f"sqrt({VAR})"
SEM = f"{STD} / sqrt(CAST({{n}} AS DOUBLE))"


def rolled(
    names: dict[str, str], windows: tuple[int, ...], source: str = "energy", places: int | None = None
) -> str:
    """Sums of whole cents are exact in both engines, so results are compared
    as they are unless ``places`` says otherwise."""
    columns = ", ".join(
        (f"round({full(sql, n)}, {places})" if places else full(sql, n)) + f" AS rolling_{name}_energy_kwh_{n}"
        for name, sql in names.items()
        for n in windows
    )
    return f"SELECT {IDS}, energy_kwh, {columns} FROM {source}"


LAGS = (1, 6, 12, 24, 48)
LAG_SQL = f"""
    SELECT {IDS}, energy_import_kwh, energy_export_kwh,
      {", ".join(f"lag(energy_{d}_kwh, {n}) OVER ({KEY}) AS lagged_{n}_energy_{d}_kwh"
                 for n in LAGS for d in ("import", "export"))}
    FROM readings"""


@query("lag_features", LAG_SQL)
def lag_features(spark, sf):
    df = views.readings(spark, sf).select(
        "object_id", "timestamp", "event_id", "energy_import_kwh", "energy_export_kwh"
    )
    return history.add_lags(df, LAGS, order=ORDER)


@query(
    "lag_features_week",
    f"""SELECT object_id, "timestamp", energy_kwh,
        lag(energy_kwh, 24) OVER ({HOUR_KEY}) AS lagged_24_energy_kwh,
        lag(energy_kwh, 168) OVER ({HOUR_KEY}) AS lagged_168_energy_kwh FROM series_hour""",
)
def lag_features_week(spark, sf):
    return history.add_lags(views.series_hour(spark, sf), (24, 168), order=HOURLY)


def _rolling(name, aggs: dict[str, str], windows=(6, 12, 24), source="energy", digits=2, places=None):
    @query(name, rolled(aggs, windows, source, places))
    def run(spark, sf):
        df = getattr(views, source)(spark, sf)
        return plain(history.add_rolling_stats(df, windows, list(aggs), order=ORDER, digits=digits), places)


_rolling("rolling_mean", {"mean": MEAN})
_rolling("rolling_std", {"std": STD})
_rolling("rolling_sum", {"sum": SUM})
_rolling("rolling_var", {"var": VAR})
_rolling("rolling_sem", {"sem": SEM})
_rolling("rolling_min_max", {"min": "min(energy_kwh) OVER {f}", "max": "max(energy_kwh) OVER {f}"})
_rolling("rolling_median", {"median": "quantile_cont(energy_kwh, 0.5) OVER {f}"}, places=6)
_rolling("rolling_missing_values", {"mean": MEAN, "std": STD, "max": "max(energy_kwh) OVER {f}"}, (2, 3, 6), "energy_gaps")
_rolling("rolling_plain_doubles", {"mean": MEAN, "std": STD, "var": VAR, "sem": SEM}, (6, 12), digits=None, places=6)


def _power(p: int) -> str:
    return " * ".join(["cents"] * p)


def skew_kurt_sql(n: int, source: str = "energy") -> str:
    frame = f"({KEY} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    sums = ", ".join(f"sum({_power(p)}) OVER {frame} AS s{p}" for p in (1, 2, 3, 4))
    return f"""
    SELECT {IDS}, energy_kwh,
      round(CASE WHEN seen = {n} AND m2 = 0 THEN 0.0::DOUBLE WHEN seen = {n} THEN
        CAST(m3 AS DOUBLE) / pow(CAST(m2 AS DOUBLE), 1.5) * sqrt({n} * ({n} - 1.0::DOUBLE)) / ({n} - 2) END, 6)
        AS rolling_skew_energy_kwh_{n},
      round(CASE WHEN seen = {n} AND m2 = 0 THEN -3.0::DOUBLE WHEN seen = {n} THEN
        ({n} - 1.0::DOUBLE) / (({n} - 2) * ({n} - 3))
        * (({n} + 1) * (CAST(m4 AS DOUBLE) / pow(CAST(m2 AS DOUBLE), 2) - 3) + 6) END, 6)
        AS rolling_kurt_energy_kwh_{n}
    FROM (SELECT *, {n} * s2 - s1 * s1 AS m2,
                 {n} * {n} * s3 - 3 * {n} * s1 * s2 + 2 * s1 * s1 * s1 AS m3,
                 {n} * {n} * {n} * s4 - 4 * {n} * {n} * s1 * s3 + 6 * {n} * s2 * s1 * s1 - 3 * s1 * s1 * s1 * s1 AS m4
          FROM (SELECT {IDS}, energy_kwh, count(energy_kwh) OVER {frame} AS seen, {sums} FROM {source}))"""


@query("rolling_skew_kurt", skew_kurt_sql(12))
def rolling_skew_kurt(spark, sf):
    return plain(history.add_rolling_stats(views.energy(spark, sf), (12,), ["skew", "kurt"], order=ORDER))


# Readings rounded so coarsely that flat windows occur; of equal values the
# skewness is 0 and the excess kurtosis -3.
FLAT = """(SELECT object_id, "timestamp", event_id, round(energy_kwh / 400) * 400 AS energy_kwh,
           CAST(round(energy_kwh / 400) AS BIGINT) AS cents FROM energy)"""


@query("rolling_skew_kurt_flat", skew_kurt_sql(4, FLAT))
def rolling_skew_kurt_flat(spark, sf):
    coarse = views.energy(spark, sf).withColumn("energy_kwh", F.round(F.col("energy_kwh") / 400) * 400)
    return plain(history.add_rolling_stats(coarse.drop("cents"), (4,), ["skew", "kurt"], order=ORDER))


@query("rolling_large_values", f"""SELECT {IDS}, round(energy_kwh * 1e6, 2) AS energy_kwh, {", ".join(
    f"round({body.format(f=f'({KEY} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)')} * 1e6, 2) AS rolling_{name}_energy_kwh_{n}"
    for n in (6, 24) for name, body in (("mean", "CASE WHEN count(cents) OVER {f} = " + str(n) + " THEN CAST(sum(cents) OVER {f} AS DOUBLE) / " + str(n) + " / 100 END"),
                                        ("std", "CASE WHEN count(cents) OVER {f} = " + str(n) + " THEN sqrt(CAST(" + str(n) + " * sum(cents * cents) OVER {f} - sum(cents) OVER {f} * sum(cents) OVER {f} AS DOUBLE) / (" + str(n) + " * " + str(n - 1) + ")) / 100 END")))}
    FROM energy""")
def rolling_large_values(spark, sf):
    large = views.energy(spark, sf).withColumn("energy_kwh", F.col("energy_kwh") * 1e6)
    made = history.add_rolling_stats(large, (6, 24), ["mean", "std"], order=ORDER, digits=3)
    return plain(made, 2)


@query(
    "rolling_count",
    f"""SELECT {IDS}, energy_kwh, {", ".join(
        f'''CASE WHEN row_number() OVER ({KEY}) >= {n}
            THEN count(energy_kwh) OVER ({KEY} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END
            AS rolling_count_energy_kwh_{n}''' for n in (6, 24))}
    FROM energy_gaps""",
)
def rolling_count(spark, sf):
    return plain(history.add_rolling_stats(views.energy_gaps(spark, sf), (6, 24), ["count"], order=ORDER))


@query(
    "rolling_rank",
    f"""WITH placed AS (SELECT {IDS}, energy_kwh, row_number() OVER ({KEY}) AS rn FROM energy)
    SELECT a.object_id, a."timestamp", a.event_id, any_value(a.energy_kwh) AS energy_kwh,
      CASE WHEN count(b.energy_kwh) = 12 THEN
        count(CASE WHEN b.energy_kwh < c.energy_kwh THEN 1 END)
        + (count(CASE WHEN b.energy_kwh = c.energy_kwh THEN 1 END) + 1) / 2.0::DOUBLE END
        AS rolling_rank_energy_kwh_12
    FROM placed a
    LEFT JOIN placed c ON c.object_id = a.object_id AND c.rn = a.rn - 1
    LEFT JOIN placed b ON b.object_id = a.object_id AND b.rn BETWEEN a.rn - 12 AND a.rn - 1
    GROUP BY a.object_id, a."timestamp", a.event_id""",
)
def rolling_rank(spark, sf):
    return plain(history.add_rolling_stats(views.energy(spark, sf), (12,), ["rank"], order=ORDER))


def averages_sql(source: str, key: str, ids: str, days: tuple[int, ...], column: str = "energy_kwh") -> str:
    frames = {f"customer_mean_{column}": f"({key} ROWS BETWEEN UNBOUNDED PRECEDING AND 24 PRECEDING)"}
    for d in days:
        frames[f"customer_{d}d_mean_{column}"] = f"({key} ROWS BETWEEN {d * 24 + 23} PRECEDING AND 24 PRECEDING)"
    columns = ", ".join(
        f"CASE WHEN count(cents) OVER {f} > 0 THEN CAST(sum(cents) OVER {f} AS DOUBLE)"
        f" / count(cents) OVER {f} / 100 END AS {name}"
        for name, f in frames.items()
    )
    return f"SELECT {ids}, energy_kwh, {columns} FROM {source}"


@query("expanding_mean", averages_sql("energy_gaps", KEY, IDS, ()))
def expanding_mean(spark, sf):
    return plain(
        history.add_customer_averages(views.energy_gaps(spark, sf), 24, (), order=ORDER, digits=2), digits=None)


def _spoiled(spark, sf):
    """Missing readings as NaN and infinity, as a source without the rule gives them."""
    odd = F.when(F.col("event_id") % 2 == 0, float("nan")).otherwise(float("inf"))
    return views.energy_gaps(spark, sf).withColumn("energy_kwh", F.coalesce("energy_kwh", odd))


@query("trailing_means_missing", averages_sql("energy_gaps", KEY, IDS, (1, 2)))
def trailing_means_missing(spark, sf):
    made = history.add_customer_averages(_spoiled(spark, sf), 24, (1, 2), order=ORDER, digits=2)
    return plain(cleaning.nan_to_null(made), digits=None)


@query(
    "trailing_means_plain_doubles",
    f"""SELECT * REPLACE ({", ".join(f"round({c}, 9) AS {c}" for c in ("customer_mean_energy_kwh", "customer_1d_mean_energy_kwh", "customer_2d_mean_energy_kwh"))})
    FROM ({averages_sql("energy_gaps", KEY, IDS, (1, 2))})""",
)
def trailing_means_plain_doubles(spark, sf):
    made = history.add_customer_averages(_spoiled(spark, sf), 24, (1, 2), order=ORDER)
    return plain(cleaning.nan_to_null(made), 9)  # fewer decimals would meet ties


@query("trailing_day_means", averages_sql("series_hour", HOUR_KEY, 'object_id, "timestamp"', (1, 7, 30, 90)))
def trailing_day_means(spark, sf):
    return plain(
        history.add_customer_averages(
            views.series_hour(spark, sf), 24, (1, 7, 30, 90), order=HOURLY, digits=2
        ), digits=None)


@query("trailing_day_means_meters", averages_sql("energy_gaps", KEY, IDS, (1, 2, 30)))
def trailing_day_means_meters(spark, sf):
    return plain(
        history.add_customer_averages(views.energy_gaps(spark, sf), 24, (1, 2, 30), order=ORDER, digits=2), digits=None)


@query(
    "horizon_index",
    f"SELECT {IDS}, energy_kwh, (row_number() OVER ({KEY}) - 1) % 24 AS horizon_index_24 FROM energy",
)
def horizon_index(spark, sf):
    return history.add_horizon_index(views.energy(spark, sf), 24, order=ORDER)


def frozen_sql(window: int, source: str, index: bool) -> str:
    block = "PARTITION BY object_id, block ORDER BY \"timestamp\", event_id"
    extra = f", (rn - 1) % {window} AS horizon_index_{window}" if index else ""
    frozen = ", ".join(
        f"first_value({c}) OVER ({block}) AS {c}_frozen"
        for c in ("lagged_1_energy_kwh", "lagged_6_energy_kwh", "rolling_mean_energy_kwh_6", "energy_kwh")
    )
    return f"""
    SELECT {IDS}, energy_kwh, lagged_1_energy_kwh, lagged_6_energy_kwh, rolling_mean_energy_kwh_6,
      {frozen}, first_value("timestamp") OVER ({block}) - INTERVAL 1 HOUR AS forecast_origin_time{extra}
    FROM (SELECT *, (rn - 1) // {window} AS block FROM (
      SELECT {IDS}, energy_kwh, row_number() OVER ({KEY}) AS rn,
        lag(energy_kwh, 1) OVER ({KEY}) AS lagged_1_energy_kwh,
        lag(energy_kwh, 6) OVER ({KEY}) AS lagged_6_energy_kwh,
        {full(MEAN, 6)} AS rolling_mean_energy_kwh_6
      FROM {source}))"""


def _with_history(df, parts):
    df = history.add_rolling_stats(df, (6,), ["mean"], parts, digits=2)
    return history.add_lags(df, (1, 6), parts)


def _frozen(df, window, part_rows=None, multi=False):
    parts = SeriesParts.measure(df, ORDER, window + 6, part_rows=part_rows)
    opened = _with_history(parts.open(df), parts)
    freeze = history.convert_to_multi_horizon if multi else history.freeze_history_features
    return plain(parts.close(freeze(opened, window, ["energy_kwh"], parts)), digits=None)


@query("frozen_features", frozen_sql(24, "energy_gaps", False))
def frozen_features(spark, sf):
    return _frozen(views.energy_gaps(spark, sf), 24)


@query("multi_horizon", frozen_sql(12, "energy_gaps", True))
def multi_horizon(spark, sf):
    return _frozen(views.energy_gaps(spark, sf), 12, multi=True)


@query(
    "forecast_origin",
    f"""SELECT {IDS}, energy_kwh,
      first_value("timestamp") OVER (PARTITION BY object_id, block ORDER BY "timestamp", event_id)
        - INTERVAL 1 HOUR AS forecast_origin_time
    FROM (SELECT *, (row_number() OVER ({KEY}) - 1) // 24 AS block FROM energy)""",
)
def forecast_origin(spark, sf):
    return history.freeze_history_features(views.energy(spark, sf), 24, order=ORDER)


@query(
    "drop_warmup",
    f"""SELECT {IDS}, energy_kwh FROM energy QUALIFY row_number() OVER ({KEY}) > 24""",
)
def drop_warmup(spark, sf):
    return cleaning.drop_warmup(views.energy(spark, sf), 24, order=ORDER)


# Readings from 1e-9 to 1e16, as whole cents times powers of two, so that SQL can
# add them up exactly as whole numbers of 2^-30.  Means are compared times ODD:
# they often end in a 5, which the two engines round differently.
ODD = 0.577215664901
POWERS = "CAST(event_id % 70 AS DOUBLE)"
ANY = f"(SELECT {IDS}, CAST(cents AS DOUBLE) * pow(2.0::DOUBLE, {POWERS} - 30) AS energy_kwh, cents * CAST(pow(2.0::DOUBLE, {POWERS}) AS HUGEINT) AS units FROM energy)"


def any_doubles_sql() -> str:
    columns = []
    for start, name in [("UNBOUNDED", "customer_mean_energy_kwh"), (47, "customer_1d_mean_energy_kwh"), (95, "customer_3d_mean_energy_kwh")]:
        frame = f"({KEY} ROWS BETWEEN {start} PRECEDING AND 24 PRECEDING)"
        mean = f"CAST(sum(units) OVER {frame} AS DOUBLE) / pow(2.0::DOUBLE, 30) / nullif(count(units) OVER {frame}, 0)"
        columns.append(f"printf('%.9e', {mean} * {ODD}::DOUBLE) AS {name}")
    return f"SELECT {IDS}, {', '.join(columns)} FROM {ANY}"


def _any_doubles(spark, sf, **options):
    cents = F.rint(F.col("energy_kwh") * 100)
    df = views.energy(spark, sf).withColumn("energy_kwh", cents * F.pow(F.lit(2.0), F.col("event_id") % 70 - 30))
    made = history.add_customer_averages(df, 24, (1, 3), order=ORDER, **options)
    names = [c for c in made.columns if c.startswith("customer_")]
    return made.select("object_id", "timestamp", "event_id", *[F.when(F.col(c).isNotNull(), F.format_string("%.9e", F.col(c) * ODD)).alias(c) for c in names])


@query("trailing_means_any_doubles", any_doubles_sql())
def trailing_means_any_doubles(spark, sf):
    return _any_doubles(spark, sf)


@query("hot_series_any_doubles", any_doubles_sql())
def hot_series_any_doubles(spark, sf):
    return _any_doubles(spark, sf, part_rows=120)


# Long windows: the same definitions over a week and a quarter of hourly rows.
LONG_AGGS = {"min": "min(energy_kwh) OVER {f}", "max": "max(energy_kwh) OVER {f}"}
SERIES_IDS = 'object_id, "timestamp"'


def long_sql(names: dict[str, str], n: int) -> str:
    columns = ", ".join(f"{full(sql, n, HOUR_KEY)} AS rolling_{name}_energy_kwh_{n}" for name, sql in names.items())
    return f"SELECT {SERIES_IDS}, energy_kwh, {columns} FROM series_hour"


def _long(spark, sf, aggs, n, **options):
    return plain(history.add_rolling_stats(views.series_hour(spark, sf), (n,), aggs, order=HOURLY, **options), None)


@query("rolling_min_max_week", long_sql(LONG_AGGS, 168))
def rolling_min_max_week(spark, sf):
    return _long(spark, sf, ["min", "max"], 168)


# Series of the given tables have a month; their rows eight times over, a month
# apart, make up more than a quarter.
EIGHT = """(SELECT object_id, "timestamp" + to_days(31 * CAST(k AS INTEGER)) AS "timestamp", round(energy_kwh * (1 + k * 0.125), 2) AS energy_kwh
           FROM series_hour, range(8) t(k))"""


@query(
    "rolling_min_max_quarter",
    f"""SELECT {SERIES_IDS}, energy_kwh, {", ".join(f"{full(sql, 2160, HOUR_KEY)} AS rolling_{name}_energy_kwh_2160" for name, sql in LONG_AGGS.items())} FROM {EIGHT}""",
)
def rolling_min_max_quarter(spark, sf):
    times = views.series_hour(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(7))))
    df = times.select(
        "object_id",
        (F.col("timestamp") + F.make_dt_interval(F.col("k") * 31)).alias("timestamp"),
        rounded(F.col("energy_kwh") * (1 + F.col("k") * 0.125), 2).alias("energy_kwh"),
    )
    return plain(history.add_rolling_stats(df, (2160,), ["min", "max"], order=HOURLY), None)


@query("rolling_median_week", f"SELECT {SERIES_IDS}, energy_kwh, round({full('quantile_cont(energy_kwh, 0.5) OVER {f}', 168, HOUR_KEY)}, 6) AS rolling_median_energy_kwh_168 FROM series_hour")
def rolling_median_week(spark, sf):
    return plain(_long(spark, sf, ["median"], 168), 6)


@query(
    "rolling_rank_week",
    f"""WITH placed AS (SELECT {SERIES_IDS}, energy_kwh, row_number() OVER ({HOUR_KEY}) AS rn FROM series_hour)
    SELECT a.object_id, a."timestamp", any_value(a.energy_kwh) AS energy_kwh,
      CASE WHEN count(b.energy_kwh) = 168 THEN count(CASE WHEN b.energy_kwh < c.energy_kwh THEN 1 END)
        + (count(CASE WHEN b.energy_kwh = c.energy_kwh THEN 1 END) + 1) / 2.0::DOUBLE END AS rolling_rank_energy_kwh_168
    FROM placed a LEFT JOIN placed c ON c.object_id = a.object_id AND c.rn = a.rn - 1
    LEFT JOIN placed b ON b.object_id = a.object_id AND b.rn BETWEEN a.rn - 168 AND a.rn - 1
    GROUP BY a."timestamp", a.object_id""",
)
def rolling_rank_week(spark, sf):
    return _long(spark, sf, ["rank"], 168)


@query("hot_series_long_windows", long_sql(LONG_AGGS | {"median": "0.5::DOUBLE * quantile_disc(energy_kwh, 0.5) OVER {f} + 0.5::DOUBLE * -quantile_disc(-energy_kwh, 0.5) OVER {f}"}, 48))
def hot_series_long_windows(spark, sf):
    return _long(spark, sf, ["min", "max", "median"], 48, part_rows=60)


# The same results where every meter counts as hot and is cut into parts.


@query("hot_series_frozen", frozen_sql(12, "energy_gaps", True))
def hot_series_frozen(spark, sf):
    return _frozen(views.energy_gaps(spark, sf), 12, part_rows=20, multi=True)


@query("hot_series_rolling", rolled({"mean": MEAN, "std": STD}, (6, 12)))
def hot_series_rolling(spark, sf):
    return plain(
        history.add_rolling_stats(
            views.energy(spark, sf), (6, 12), ["mean", "std"], order=ORDER, digits=2, part_rows=14
        ), digits=None)


@query("hot_series_averages", averages_sql("series_hour", HOUR_KEY, 'object_id, "timestamp"', (1, 3)))
def hot_series_averages(spark, sf):
    return plain(
        history.add_customer_averages(
            views.series_hour(spark, sf), 24, (1, 3), order=HOURLY, digits=2, part_rows=100
        ), digits=None)


# All readings of a month share one time; event numbers order them.
MONTH_KEY = 'PARTITION BY object_id ORDER BY "timestamp", event_id'


@query(
    "hot_series_same_second",
    f"""SELECT object_id, "timestamp", event_id, energy_kwh, lag(energy_kwh, 1) OVER ({MONTH_KEY}) AS lagged_1_energy_kwh,
      lag(energy_kwh, 6) OVER ({MONTH_KEY}) AS lagged_6_energy_kwh
    FROM (SELECT * REPLACE (date_trunc('month', "timestamp") AS "timestamp") FROM energy)""",
)
def hot_series_same_second(spark, sf):
    df = views.energy(spark, sf).withColumn("timestamp", F.date_trunc("month", "timestamp").cast("timestamp_ntz"))
    return history.add_lags(df, (1, 6), order=ORDER, part_rows=60)


@query(
    "hot_series_positions",
    f"SELECT {IDS}, energy_kwh, (row_number() OVER ({KEY}) - 1) % 24 AS horizon_index_24 FROM energy",
)
def hot_series_positions(spark, sf):
    return history.add_horizon_index(views.energy(spark, sf), 24, order=ORDER, part_rows=10)
