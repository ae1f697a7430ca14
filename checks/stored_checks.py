"""Features that follow new readings, stored layouts, appends."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterframe.operators import appended, history, models, splits
from meterframe.operators.moving import MovingRidge
from meterframe.session import fresh_path
from meterframe.sources.stored import store_series, stored_series
from meterframe.sources.versions import Dataset
from meterframe.streaming.features import FeatureStore, Wanted

from . import views
from .feature_checks import ASSIGNED
from .history_checks import IDS, KEY, MEAN, STD, averages_sql, full
from .registry import plain, query
from .views import BOUNDS, ORDER

WANTED = Wanted((1, 24), (6, 24), ("mean", "std"), 24, (1, 2))


def features_sql(source: str) -> str:
    """Lags, rolling aggregates and long averages of all rows of ``source``."""
    lags = ", ".join(f"lag(energy_kwh, {n}) OVER ({KEY}) AS lagged_{n}_energy_kwh" for n in WANTED.lags)
    rolled = ", ".join(
        f"{full(sql, n)} AS rolling_{name}_energy_kwh_{n}" for name, sql in (("mean", MEAN), ("std", STD)) for n in WANTED.windows
    )
    long = averages_sql(source, KEY, IDS, tuple(WANTED.windows_days)).replace(
        "energy_kwh, CASE", f"energy_kwh, {lags}, {rolled}, CASE", 1
    )
    return long


def in_batches(spark, sf, arrival):
    """Three batches by ``arrival``, by two stores on one folder; the second batch
    comes twice, the second time by a store that has not seen it."""
    df = views.energy_gaps(spark, sf).withColumn("arrival", F.expr(arrival))
    root = fresh_path(spark, "features")

    def store():
        return FeatureStore(spark, root, ("energy_kwh",), WANTED, ORDER, block_rows=16)

    first, again = store(), store()
    for s, batch in ((first, 0), (first, 1), (again, 1), (again, 2)):
        s.apply(df.where(F.col("arrival") == batch).drop("arrival"), batch)
    return again


TEN_DAYS = "least((extract('day' FROM \"timestamp\") - 1) // 10, 2)"
BY_DAY = "least((dayofmonth(timestamp) - 1) div 10, 2)"


@query("incremental_features", features_sql("energy_gaps"))
def incremental_features(spark, sf):
    return plain(in_batches(spark, sf, BY_DAY).features(), digits=None)


# Each fiftieth reading is delivered one batch later; where its meter has later
# rows by then, it is late and belongs to no feature.
DELIVERED = f"""arrived AS (SELECT *, {TEN_DAYS} + CASE WHEN event_id % 50 = 0 AND {TEN_DAYS} < 2 THEN 1 ELSE 0 END AS batch FROM energy_gaps),
    judged AS (SELECT a.*, EXISTS (SELECT 1 FROM arrived e WHERE e.object_id = a.object_id AND e.batch < a.batch
        AND (e."timestamp" > a."timestamp" OR (e."timestamp" = a."timestamp" AND e.event_id > a.event_id))) AS late FROM arrived a)"""
BY_DELIVERY = f"{BY_DAY} + if(event_id % 50 = 0 and {BY_DAY} < 2, 1, 0)"


@query("incremental_features_late", f"WITH {DELIVERED} {features_sql('(SELECT * FROM judged WHERE NOT late)')}")
def incremental_features_late(spark, sf):
    return plain(in_batches(spark, sf, BY_DELIVERY).features(), digits=None)


@query("late_readings", f"WITH {DELIVERED} SELECT {IDS}, energy_kwh FROM judged WHERE late")
def late_readings(spark, sf):
    return in_batches(spark, sf, BY_DELIVERY).late()


def _stored(spark, sf, part_rows=None):
    path = fresh_path(spark, "stored")
    table = f"s{path.rsplit('-', 1)[1]}"
    store_series(views.energy(spark, sf), table, path, 24, 8, ORDER, part_rows)
    return stored_series(spark, table)


LAGGED = f"""SELECT {IDS}, energy_kwh, lag(energy_kwh, 1) OVER ({KEY}) AS lagged_1_energy_kwh,
    lag(energy_kwh, 24) OVER ({KEY}) AS lagged_24_energy_kwh FROM energy"""


@query("lag_features_stored", LAGGED)
def lag_features_stored(spark, sf):
    return _stored(spark, sf).build(spark, lambda df, parts: history.add_lags(df, (1, 24), parts))


@query("lag_features_stored_hot", LAGGED)
def lag_features_stored_hot(spark, sf):
    """Meters stored in parts."""
    return _stored(spark, sf, 30).build(spark, lambda df, parts: history.add_lags(df, (1, 24), parts))


@query(
    "append_table_twice",
    'SELECT * EXCLUDE (event_id), 1 AS copies FROM readings UNION ALL BY NAME SELECT * EXCLUDE (event_id), 2 AS copies FROM doubled',
)
def append_table_twice(spark, sf):
    """Two appends, each of them again with its batch id, and one without."""
    data = Dataset(spark, fresh_path(spark, "versions"))
    rows = views.readings(spark, sf).drop("event_id")
    moved = views.doubled(spark, sf).drop("event_id")
    for batch in ("january", "january", "october", "january", "october"):
        data.append((rows if batch == "january" else moved).withColumn("copies", F.lit(1 if batch == "january" else 2)), batch)
    return plain(data.read(), digits=None)


@query(
    "replace_versions",
    "SELECT * EXCLUDE (event_id) FROM readings WHERE tariff_code IS NOT NULL",
)
def replace_versions(spark, sf):
    """Readings replaced by those that did not fail."""
    data = Dataset(spark, fresh_path(spark, "versions"))
    rows = views.readings(spark, sf).drop("event_id")
    data.append(rows, "all")
    data.replace(data.read().where("tariff_code IS NOT NULL"))
    data.append(rows, "all")
    return plain(data.read(), digits=None)


@query("published_splits", ASSIGNED)
def published_splits(spark, sf):
    """A build of half the rows, then one of all."""
    root, table = fresh_path(spark, "splits"), splits.assign_split(views.energy(spark, sf), BOUNDS)
    splits.publish_splits(table.where("event_id % 2 = 0"), root)
    return splits.publish_splits(table, root).read()


# Meters' hours in one of three months; what is stored and what is appended share
# the hour 15, and the hour 20 of the batch comes twice.
MOVED = """moved AS (SELECT object_id, "timestamp" + to_months(CAST(object_id AS INT) % 3) AS "timestamp" FROM hourly),
    batch AS (SELECT * FROM moved WHERE extract('hour' FROM "timestamp") >= 15
              UNION ALL SELECT * FROM moved WHERE extract('hour' FROM "timestamp") = 20)"""


@query(
    "append_key_violations",
    f"""WITH {MOVED}, counted AS (SELECT "timestamp", object_id, count(*) AS in_batch FROM batch GROUP BY ALL)
    SELECT c.*, (SELECT count(*) FROM moved m WHERE extract('hour' FROM m."timestamp") <= 15
                 AND m."timestamp" = c."timestamp" AND m.object_id = c.object_id) AS in_store
    FROM counted c WHERE in_batch + (SELECT count(*) FROM moved m WHERE extract('hour' FROM m."timestamp") <= 15
                 AND m."timestamp" = c."timestamp" AND m.object_id = c.object_id) > 1""",
)
def append_key_violations(spark, sf):
    moved = views.hourly(spark, sf).select(
        "object_id", F.expr("timestamp + make_ym_interval(0, cast(object_id as int) % 3)").alias("timestamp")
    ).withColumn("month", appended.month_of())
    hour = F.hour("timestamp")
    path = fresh_path(spark, "months")
    moved.where(hour <= 15).write.partitionBy("month").parquet(path)
    stored = spark.read.option("inferSchema", "false").parquet(path).withColumn("month", F.col("month").cast("string"))
    filters = fresh_path(spark, "filters")
    appended.key_filter(stored).write.parquet(filters)
    batch = moved.where(hour >= 15).unionByName(moved.where(hour == 20))
    return appended.append_key_violations(batch, stored, spark.read.parquet(filters))


# A regression on the reading before, refitted on three spans of fifteen days; each
# predicts the five days after it.
MOVING = f"""WITH lagged AS (SELECT *, least((extract('day' FROM "timestamp") - 1) // 5, 5) AS p,
      lag(energy_kwh, 1) OVER ({KEY}) AS x, lag(cents, 1) OVER ({KEY}) AS px FROM energy),
    spans AS (SELECT unnest([0, 1, 2]) AS span),
    summed AS (SELECT span, object_id, CAST(count(*) AS DOUBLE) AS n, sum(px) AS tx,
        CAST(sum(px) AS DOUBLE) AS sx, CAST(sum(cents) AS DOUBLE) AS sy,
        CAST(count(*) * sum(px * cents) - sum(px) * sum(cents) AS DOUBLE) AS cxy,
        CAST(count(*) * sum(px * px) - sum(px) * sum(px) AS DOUBLE) AS cxx
      FROM lagged JOIN spans ON p BETWEEN span AND span + 2 WHERE px IS NOT NULL GROUP BY span, object_id),
    fitted AS (SELECT *, CASE WHEN cxx = 0 THEN 0.0 ELSE cxy / cxx END AS slope FROM summed)
    SELECT span, object_id, "timestamp", energy_kwh AS y_true, round((sy - slope * sx) / n / 100 + slope * x, 4) AS y_pred
    FROM lagged JOIN fitted USING (object_id) WHERE p = span + 3 AND x IS NOT NULL"""


@query("per_customer_ridge_moving", MOVING)
def per_customer_ridge_moving(spark, sf):
    """Rows without a reading before them are left out; each span adds the sums
    of its new days and reads those of the others."""
    df = history.add_lags(views.energy(spark, sf), (1,), order=ORDER).where("lagged_1_energy_kwh is not null")
    df = df.withColumn("p", F.expr("least((dayofmonth(timestamp) - 1) div 5, 5)"))
    feature = ["lagged_1_energy_kwh"]
    moving = MovingRidge(spark, fresh_path(spark, "moving"), feature, "energy_kwh")
    out = None
    for span in range(3):
        for p in range(span, span + 3):
            moving.add(df.where(F.col("p") == p), str(p))
        fitted = moving.fit([str(p) for p in range(span, span + 3)], penalty=0.0)
        made = models.predict_ridge(fitted, df.where(F.col("p") == span + 3), feature, "energy_kwh", ORDER)
        made = made.withColumn("span", F.lit(span))
        out = made if out is None else out.unionByName(made)
    return plain(out, 4)
