import random

import numpy as np
import pytest

from meterframe.operators import continuity
from meterframe.operators.continuity import continuity_runs, merged_runs
from meterframe.operators.quality import time_continuity


def by_hand(rows, step):
    out = {}
    for meter in {m for m, _ in rows}:
        times = sorted(t for m, t in rows if m == meter)
        gaps = sum(b - a > step for a, b in zip(times, times[1:]))
        out[meter] = (len(times) - gaps, gaps, 0)
    return out


def panel(spark, rows):
    df = spark.createDataFrame(rows, "object_id string, m long")
    return df.selectExpr("object_id", "timestamp_ntz'2019-12-31 20:00:00' + make_dt_interval(0, 0, m) AS timestamp")


def minutes(seed, n=800):
    rng = random.Random(seed)
    out = []
    for meter in ("a", "b", "c"):
        at = -10_000
        for _ in range(n // 3):
            at += rng.choice([0, 15, 60, 60, 60, 61, 300, 60 * 5000 if rng.random() < 0.05 else 60])
            out.append((meter, at))
    rng.shuffle(out)
    return out + [("single", 5), ("twice", 7), ("twice", 7)]


@pytest.mark.parametrize("hours", [1, 2, 0.25])
def test_equals_sorted_rows(spark, hours):
    rows = minutes(1)
    df = panel(spark, rows).repartition(7)
    got = {r.object_id: (r.ok, r.gap, r.time_reversal) for r in continuity_runs(df, expected_step_hours=hours).collect()}
    assert got == by_hand(rows, hours * 60)
    assert got == {r.object_id: (r.ok, r.gap, r.time_reversal) for r in time_continuity(df, expected_step_hours=hours).collect()}


def test_runs_that_do_not_shrink_are_handed_on(spark, monkeypatch):
    rows = minutes(2)
    monkeypatch.setattr(continuity, "HELD_ROWS", 40)
    monkeypatch.setattr(continuity, "BIN_STEPS", 16)
    got = {r.object_id: (r.ok, r.gap, 0) for r in continuity_runs(panel(spark, rows)).collect()}
    assert got == by_hand(rows, 60)


def test_runs_merge_in_any_order():
    rng = np.random.default_rng(3)
    times, code = rng.integers(0, 3000, 500), rng.integers(0, 3, 500)
    ones = np.ones(500, np.int64)
    whole = merged_runs(code, times, times, ones, 5)
    for _ in range(5):
        parts = np.array_split(rng.permutation(500), 4)
        runs = [merged_runs(code[p], times[p], times[p], ones[p], 5) for p in parts]
        rng.shuffle(runs)
        first = merged_runs(*[np.concatenate(c) for c in zip(*runs[:2])], 5)
        again = merged_runs(*[np.concatenate(c) for c in zip(first, *runs[2:])], 5)
        assert all((a == b).all() for a, b in zip(whole, again))


def test_only_runs_are_shuffled(spark):
    """A series in order sends one run from each task, however many rows it has."""
    df = spark.range(0, 200_000, 1, 4).selectExpr("'m' AS object_id", "timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(0, id) AS timestamp")
    runs = continuity._task_runs(df, "object_id", "timestamp", 3_600_000_000)
    assert runs.count() == 4
    assert [tuple(r) for r in continuity_runs(df).collect()] == [("m", 200_000, 0, 0)]
    plan = continuity_runs(df)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning") :]  # what is under the first exchange
    assert "MapInArrow" in below and "Window" not in below


def test_missing_times_are_an_error(spark):
    df = spark.createDataFrame([("a", None)], "object_id string, timestamp timestamp_ntz")
    with pytest.raises(Exception, match="remove them first"):
        continuity_runs(df).collect()


def test_empty(spark):
    assert continuity_runs(panel(spark, [("a", 1)]).where("false")).collect() == []
