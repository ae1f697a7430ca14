"""A series that is cut into parts gives what the whole series gives."""

import random

import pytest
from conftest import in_order
from pyspark.sql import functions as F

from meterframe.operators import history
from meterframe.operators import series as layout
from meterframe.operators.series import SeriesOrder, SeriesParts


def rows_of(seed, meters=3, most=120):
    rnd = random.Random(seed)
    out = []
    for m in range(meters):
        hours = sorted(rnd.sample(range(400), rnd.randint(1, most)))
        if seed % 2:
            hours = [-400_000, *hours]  # one reading decades before the others
        out += [(f"m{m}", h, None if rnd.random() < 0.1 else rnd.randint(0, 5000) / 100) for h in hours]
    return out


def features(df, parts):
    df = history.add_rolling_stats(df, (3, 5), ["mean", "std", "max", "count"], parts, digits=2)
    df = history.add_lags(df, (1, 7), parts)
    df = history.add_customer_averages(df, 2, (1,), parts, digits=2)
    return history.convert_to_multi_horizon(df, 6, ["energy_kwh"], parts)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("part_rows", [30, 45])
def test_cut_equals_whole(panel, seed, part_rows):
    df = panel(rows_of(seed))
    whole = SeriesParts.measure(df, lookback=26, carried=["energy_kwh"], digits=2)
    cut = SeriesParts.measure(df, lookback=26, carried=["energy_kwh"], digits=2, part_rows=part_rows)
    assert not whole.is_cut
    expected = features(whole.open(df), whole)
    got = cut.close(features(cut.open(df), cut))
    assert got.columns == expected.columns
    assert in_order(got, *got.columns) == in_order(expected, *expected.columns)


def test_parts_are_bounded_and_rows_whole(panel):
    df = panel([("hot", h, 1.0) for h in range(1000)] + [(f"m{i}", 0, 1.0) for i in range(50)])
    parts = SeriesParts.measure(df, lookback=10, part_rows=100)
    opened = parts.open(df)
    sizes = opened.groupBy("object_id", layout.PART).agg(
        F.count_if(~F.col(layout.HALO)).alias("own"), F.count_if(F.col(layout.HALO)).alias("halo")
    )
    biggest = sizes.agg(F.max("own"), F.max("halo")).first()
    assert biggest[0] <= 125 and 10 <= biggest[1] <= 25
    assert sizes.where("object_id = 'hot'").count() >= 8
    closed = parts.close(opened)
    assert closed.exceptAll(df).count() == 0 and df.exceptAll(closed).count() == 0


def test_burst_is_cut_again(panel):
    """All but one row lie in one coarse bin."""
    df = panel([("hot", -2_000_000, 1.0)] + [("hot", h, 1.0) for h in range(1000)])
    parts = SeriesParts.measure(df, lookback=5, part_rows=50)
    assert parts.bins[1] is not None
    own = parts.open(df).where(~F.col(layout.HALO)).groupBy(layout.PART).count()
    assert own.agg(F.max("count")).first()[0] <= 100


def test_one_second_is_cut_by_ties(spark):
    """5,000 rows of one meter in one second, fifty to a part."""
    order = SeriesOrder(ties=("event_id",))
    df = spark.range(5000).select(
        F.lit("hot").alias("object_id"),
        (F.col("id") * 7919 % 5000).alias("event_id"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("timestamp"),
        (F.col("id") % 97).cast("double").alias("energy_kwh"),
    )
    whole = SeriesParts.measure(df, order, 26, ["energy_kwh"], 2)
    cut = SeriesParts.measure(df, order, 26, ["energy_kwh"], 2, part_rows=50)
    own = cut.open(df).where(~F.col(layout.HALO)).groupBy(layout.PART).count()
    assert own.agg(F.max("count")).first()[0] <= 100 and own.agg(F.sum("count")).first()[0] == 5000
    expected, got = features(whole.open(df), whole), cut.close(features(cut.open(df), cut))
    assert got.count() == 5000 and got.exceptAll(expected).count() == 0


def test_missing_keys_are_refused(panel):
    df = panel([(None, 1, 1.0), ("a", 1, 1.0)])
    with pytest.raises(ValueError, match="no object_id"):
        history.add_lags(df, (1,))


def test_needed_lookback_is_checked(panel):
    df = panel([("hot", h, 1.0) for h in range(100)])
    parts = SeriesParts.measure(df, lookback=2, part_rows=10)
    with pytest.raises(ValueError, match="look back"):
        history.add_lags(parts.open(df), (5,), parts)


def test_one_exchange_for_all_features(panel):
    """Features on shared parts need one shuffle and one sort."""
    df = panel([("a", h, 1.0) for h in range(10)]).repartition(2)
    parts = SeriesParts.measure(df, lookback=26)
    plan = features(df, parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_ties_fix_the_order(spark):
    df = spark.createDataFrame(
        [("a", 2, 20.0), ("a", 1, 10.0), ("a", 3, 30.0)], "object_id string, event_id int, energy_kwh double"
    ).withColumn("timestamp", F.lit("2020-01-01").cast("timestamp_ntz"))
    out = history.add_lags(df, (1,), order=SeriesOrder(ties=("event_id",)))
    found = {r["event_id"]: r["lagged_1_energy_kwh"] for r in out.collect()}
    assert found == {1: None, 2: 10.0, 3: 20.0}
