"""Readings stored by meter and time, and appends checked by key filters."""

import pytest
from pyspark.sql import functions as F

from meterframe.operators import appended, history
from meterframe.session import fresh_path
from meterframe.sources.stored import store_series, stored_series

from test_incremental import random_rows, same


def stored(spark, df, **more):
    path = fresh_path(spark, "stored")
    table = f"s{path.rsplit('-', 1)[1]}"
    store_series(df, table, path, 30, 4, **more)
    return stored_series(spark, table)


@pytest.mark.parametrize("part_rows", [None, 31])
def test_windows_without_exchange_or_sort(spark, panel, part_rows):
    df = panel(random_rows(5, hot=200))
    layer = stored(spark, df, part_rows=part_rows)

    def build(frame, parts):
        return history.add_rolling_stats(history.add_lags(frame, (1, 24), parts), (6, 24), ["mean"], parts, digits=2)

    got = layer.build(spark, build)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" in plan
    same(got, history.add_rolling_stats(history.add_lags(df, (1, 24)), (6, 24), ["mean"], digits=2))
    same(layer.rows(spark), df)
    cut = spark.table(layer.table).agg(F.max("__part")).first()[0]
    assert (cut > 0) == (part_rows is not None)


def test_more_rows_than_were_stored_before_a_part(spark, panel):
    layer = stored(spark, panel(random_rows(6, hot=200)), part_rows=31)
    with pytest.raises(ValueError, match="look back"):
        layer.build(spark, lambda df, parts: history.add_lags(df, (31,), parts))


def test_other_tables_are_refused(spark):
    path = fresh_path(spark, "other")
    spark.range(1).write.option("path", path).saveAsTable("other_table")
    with pytest.raises(ValueError, match="not stored"):
        stored_series(spark, "other_table")
    spark.sql("DROP TABLE other_table")


KEYS = "object_id string, timestamp timestamp_ntz"


def keys(spark, rows):
    from datetime import datetime

    made = [(m, None if t is None else datetime(2024, *t)) for m, t in rows]
    return spark.createDataFrame(made, KEYS).withColumn("month", appended.month_of())


def months(spark, df):
    path = fresh_path(spark, "months")
    df.write.partitionBy("month").parquet(path)
    return spark.read.schema("object_id string, timestamp timestamp_ntz, month string").parquet(path)


@pytest.mark.parametrize("words", [1, 1 << 10])
def test_repeated_keys(spark, words):
    """A filter of one word has all bits set: all keys are looked up, with the same result."""
    there = [(f"m{i}", (1 + i % 3, 1 + i % 28)) for i in range(200)]
    store = months(spark, keys(spark, [*there, ("m1", (2, 2)), (None, (1, 5)), ("x", None)]))
    batch = keys(spark, [("m0", (1, 1)), ("m1", (2, 2)), ("m1", (2, 2)), ("new", (3, 3)), ("twice", (5, 1)),
                         ("twice", (5, 1)), (None, (1, 5)), ("x", None), ("y", None), ("m0", (1, 2))])
    got = appended.append_key_violations(batch, store, appended.key_filter(store, words=words), words=words)
    found = {(r.object_id, r.timestamp and (r.timestamp.month, r.timestamp.day)): (r.in_batch, r.in_store) for r in got.collect()}
    assert found == {("m0", (1, 1)): (1, 1), ("m1", (2, 2)): (2, 2), ("twice", (5, 1)): (2, 0), (None, (1, 5)): (1, 1), ("x", None): (1, 1)}


def test_only_months_of_suspects_are_read(spark):
    store = months(spark, keys(spark, [(f"m{i}", (1 + i % 6, 1 + i % 28)) for i in range(120)]))
    batch = keys(spark, [("m0", (1, 1)), ("new", (2, 3)), ("newer", (3, 3))])
    filters = appended.key_filter(store)
    got = appended.append_key_violations(batch, store, filters)
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan and "2024-01" in plan and "2024-02" not in plan
    read = {path.split("month=")[1][:7] for path in got.inputFiles() if "month=" in path}
    assert read <= {f"2024-0{m}" for m in range(1, 7)}


def test_filters_of_batches_merge(spark):
    first, second = (keys(spark, [(f"m{i}", (1, 1)) for i in part]) for part in (range(50), range(50, 100)))
    merged = appended.merge_filters(appended.key_filter(first), appended.key_filter(second))
    whole = appended.key_filter(first.unionByName(second))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))


def test_empty_tables(spark):
    none = keys(spark, [("a", (1, 1))]).limit(0)
    some = keys(spark, [("a", (1, 1))])
    assert appended.append_key_violations(none, some, appended.key_filter(some)).count() == 0
    assert appended.append_key_violations(some, none, appended.key_filter(none)).count() == 0
