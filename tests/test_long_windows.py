import math
import random
import statistics

import pytest

from conftest import in_order
from meterframe.functions import long_windows
from meterframe.functions.long_windows import SortedWindow
from meterframe.operators import history

AGGS = ["min", "max", "median", "rank"]


def by_hand(values, n):
    out = []
    for i in range(len(values)):
        seen = values[max(i - n, 0) : i]
        if len(seen) < n or None in seen:
            out.append((None,) * 4)
            continue
        below, equal = sum(v < seen[-1] for v in seen), seen.count(seen[-1])
        out.append((min(seen), max(seen), statistics.median(seen), below + (equal + 1) / 2))
    return out


def series(seed):
    rng = random.Random(seed)
    return {m: [None if rng.random() < 0.01 else float(rng.randint(-20, 20)) for _ in range(size)] for m, size in (("a", 300), ("b", 45), ("c", 1), ("d", 92))}


@pytest.mark.parametrize("windows, part_rows", [((40,), None), ((33, 45), 50), ((6, 90), 120)])
def test_equals_brute_force(spark, panel, windows, part_rows):
    values = series(sum(windows))
    df = panel([(m, h, v) for m, vs in values.items() for h, v in enumerate(vs)]).repartition(5)
    names = [f"rolling_{a}_energy_kwh_{n}" for n in windows for a in AGGS]
    made = history.add_rolling_stats(df, windows, AGGS, part_rows=part_rows)
    assert made.columns == ["object_id", "timestamp", "energy_kwh", *names]
    got = in_order(made, *names)
    expected = [sum(rows, ()) for m in sorted(values) for rows in zip(*[by_hand(values[m], n) for n in windows])]
    assert got == expected


def test_one_exchange(spark, panel):
    df = panel([("a", h, float(h)) for h in range(50)])
    plan = history.add_rolling_stats(df, (40,), AGGS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_rows_out_of_order_are_an_error(spark, panel):
    df = panel([("a", h, float(h)) for h in range(50)])
    from pyspark.sql import Window

    wrong = Window.partitionBy("object_id").orderBy("timestamp")
    placed = long_windows.with_ordered(df, ["energy_kwh"], ["energy_kwh"], [40], ["rank"], wrong)
    with pytest.raises(Exception, match="not in order"):
        placed.collect()


def test_sorted_window_takes_nan_as_infinity():
    window = SortedWindow(3)
    for v in (1.0, float("nan"), 2.0):
        window.push(v)
    assert window.full and window.median() == 2.0
    for v in (None, float("nan")):
        window.push(v)
    assert not window.full and window.sorted == [2.0, math.inf]
