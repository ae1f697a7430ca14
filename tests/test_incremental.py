"""Features of batches equal those of the whole panel."""

import random

import pytest
from pyspark.sql import functions as F

from meterframe.operators import history
from meterframe.session import fresh_path
from meterframe.streaming.features import FeatureStore, Wanted, follow

WANTED = Wanted((1, 3), (2, 4), ("mean", "std", "sum"), 2, (1,), digits=2)


def whole(df):
    df = history.add_lags(df, WANTED.lags)
    df = history.add_rolling_stats(df, WANTED.windows, WANTED.aggs, digits=2)
    return history.add_customer_averages(df, WANTED.shift_hours, WANTED.windows_days, digits=2)


def store(spark, root=None, **more):
    return FeatureStore(spark, root or fresh_path(spark, "features"), ("energy_kwh",), WANTED, **more)


def same(got, expected):
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    left = sorted(map(str, got.select(columns).collect()))
    assert left == sorted(map(str, expected.select(columns).collect()))


def random_rows(seed, hot=60):
    rng = random.Random(seed)
    rows = [("hot", h, None if rng.random() < 0.1 else rng.randrange(1000) / 100) for h in range(hot)]
    for meter in "abc":
        rows += [(meter, h, rng.randrange(1000) / 100) for h in rng.sample(range(hot), rng.randrange(1, 20))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_the_whole(spark, panel, seed):
    rows = random_rows(seed)
    made = store(spark, block_rows=8)
    for batch, (low, high) in enumerate([(0, 5), (5, 40), (40, 41), (41, 99)]):
        made.apply(panel([r for r in rows if low <= r[1] < high]), batch)
    same(made.features(), whole(panel(rows)))
    assert made.late().count() == 0


def test_a_batch_that_was_cut_off(spark, panel, monkeypatch):
    rows = random_rows(3)
    made = store(spark, block_rows=8)
    early, late = panel([r for r in rows if r[1] < 30]), panel([r for r in rows if r[1] >= 30])
    made.apply(early, 7)

    def fail(*_):
        raise OSError("lost")

    for step in ("_write_log", "_looked_up", "_write_heads"):
        with monkeypatch.context() as m:
            m.setattr(FeatureStore, step, fail)
            with pytest.raises(OSError):
                made.apply(late, 8)
        assert made.applied() == [7]
        same(made.features(), whole(early))
    again = store(spark, made.root, block_rows=8)
    assert again.apply(late, 8)
    assert not again.apply(late, 8) and not again.apply(early, 7)
    same(again.features(), whole(panel(rows)))


def test_late_rows(spark, panel):
    made = store(spark)
    made.apply(panel([("a", 5, 1.0), ("b", 1, 2.0)]), 0)
    made.apply(panel([("a", 4, 3.0), ("a", 5, 9.0), ("a", 6, 4.0), ("b", 2, 5.0), ("new", 0, 6.0)]), 1)
    made.apply(panel([("a", 3, 7.0)]), 2)  # nothing but late rows
    late = {(r.object_id, r.energy_kwh) for r in made.late().collect()}
    assert late == {("a", 3.0), ("a", 9.0), ("a", 7.0)}
    made.apply(panel([("a", 7, 8.0)]), 3)
    same(made.features(), whole(panel([("a", 5, 1.0), ("a", 6, 4.0), ("a", 7, 8.0), ("b", 1, 2.0), ("b", 2, 5.0), ("new", 0, 6.0)])))


def test_empty_batches(spark, panel):
    made = store(spark)
    with pytest.raises(FileNotFoundError):
        made.features()
    none = panel([("a", 0, 1.0)]).limit(0)
    assert made.apply(none, 0)
    assert made.features().count() == 0
    rows = [("a", h, float(h)) for h in range(6)]
    made.apply(panel(rows), 1)
    made.apply(none, 2)
    same(made.features(), whole(panel(rows)))


def test_rows_without_meter_or_time(spark, panel):
    with pytest.raises(ValueError, match="1 rows"):
        store(spark).apply(panel([("a", 0, 1.0), (None, 1, 1.0)]), 0)
    odd = panel([("a", 0, 1.0), ("b", 1, 1.0)]).withColumn("timestamp", F.expr("if(object_id = 'a', null, timestamp)"))
    with pytest.raises(ValueError, match="1 rows"):
        store(spark).apply(odd, 0)


def test_readings_that_are_not_finite_and_other_columns(spark, panel):
    rows = [("a", h, [1.0, float("nan"), 2.5, float("inf"), None][h % 5]) for h in range(12)]
    df = panel(rows).withColumn("a.b", F.lit("x")).withColumn("batch", F.lit(1))
    made = store(spark)
    made.apply(df.where("timestamp < '2020-01-01 05:00:00'"), 0)
    made.apply(df.where("timestamp >= '2020-01-01 05:00:00'"), 1)
    got = made.features()
    assert {"a.b", "batch"} <= set(got.columns)
    columns = [c for c in got.columns if c.startswith(("customer_", "rolling_", "lagged"))]
    expected = whole(df.drop("a.b", "batch"))
    a = {r.timestamp: [str(r[c]) for c in columns] for r in got.collect()}
    assert a == {r.timestamp: [str(r[c]) for c in columns] for r in expected.collect()}


def test_cost_follows_the_batch(spark, panel):
    """A batch sends each of its rows' offsets once, however long the history is."""
    made = store(spark, block_rows=8)
    made.apply(panel([("a", h, 1.0) for h in range(200)]), 0)
    made.apply(panel([("a", 200, 1.0), ("a", 201, 1.0)]), 1)
    spans = spark.createDataFrame([("a", 200, 201, 2)], "object_id string, __first long, __end long, __n long")
    reach = max(WANTED.offsets)
    blocks = {r[0] for r in made._log(spans).select("__block").distinct().collect()}
    assert blocks <= {b for o in [0, *WANTED.offsets] for b in range((200 - o) // 8, (201 - o) // 8 + 1)}
    assert len(blocks) < (200 + reach) // 8


def test_unknown_aggregates():
    with pytest.raises(ValueError, match="median"):
        Wanted(aggs=("median",))


def test_stream_that_starts_again(spark, panel):
    rows = random_rows(4)
    source, checkpoint = fresh_path(spark, "source"), fresh_path(spark, "checkpoint")
    root = fresh_path(spark, "features")
    for low, high in ((0, 20), (20, 45), (45, 99)):
        part = panel([r for r in rows if low <= r[1] < high])
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        assert follow(stream, store(spark, root, block_rows=8), checkpoint).awaitTermination(120)
    same(store(spark, root).features(), whole(panel(rows)))
