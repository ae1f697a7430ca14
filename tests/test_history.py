import math
import statistics
from datetime import datetime

import pytest
from conftest import in_order

from meterframe.operators import history

VALUES = [1.0, 4.0, 2.0, None, 8.0, 5.0, 7.0, 3.0]


@pytest.fixture
def two(panel):
    return panel([("a", h, v) for h, v in enumerate(VALUES)] + [("b", h, h + 0.5) for h in range(3)])


def test_lag_stays_within_a_meter(two):
    out = in_order(history.add_lags(two, (1, 5)), "object_id", "lagged_1_energy_kwh", "lagged_5_energy_kwh")
    assert [r[1] for r in out if r[0] == "a"] == [None, *VALUES[:-1]]
    assert [r[2] for r in out if r[0] == "a"] == [None] * 5 + VALUES[:3]
    assert [r[1:] for r in out if r[0] == "b"] == [(None, None), (0.5, None), (1.5, None)]


def test_two_energy_columns(panel):
    df = panel([("a", h, float(h)) for h in range(3)], "energy_import")
    df = df.selectExpr("*", "energy_import * 2 AS energy_export")
    out = history.add_lags(df, (1,))
    assert out.columns[-2:] == ["lagged_1_energy_import", "lagged_1_energy_export"]
    with pytest.raises(ValueError):
        history.add_lags(df.drop("energy_import", "energy_export"), (1,))


@pytest.mark.parametrize("digits", [None, 2])
def test_rolling_needs_all_values(two, digits):
    out = history.add_rolling_stats(two, (2, 3), ["mean", "std", "sum", "var", "sem"], digits=digits)
    for n in (2, 3):
        names = [f"rolling_{a}_energy_kwh_{n}" for a in ("mean", "std", "sum", "var", "sem")]
        found = [r[1:] for r in in_order(out, "object_id", *names) if r[0] == "a"]
        for i, got in enumerate(found):
            window = VALUES[max(0, i - n) : i]
            if len(window) < n or None in window:
                assert got == (None,) * 5
            else:
                sd = statistics.stdev(window)
                expected = (statistics.mean(window), sd, sum(window), sd**2, sd / math.sqrt(n))
                assert got == pytest.approx(expected)


def test_rolling_by_other_names(two):
    out = history.add_rolling_stats(two, (4,), ["min", "max", "median", "rank", "count"])
    names = [f"rolling_{a}_energy_kwh_4" for a in ("min", "max", "median", "rank", "count")]
    found = [r[1:] for r in in_order(out, "object_id", *names) if r[0] == "a"]
    # Only a frame with a null or too few rows before it here ...
    assert found[7] == (None, None, None, None, 3)
    assert [r[4] for r in found] == [None, None, None, 3, 3, 3, 3, 3]
    whole = history.add_rolling_stats(two.where("energy_kwh is not null"), (4,), ["min", "max", "median", "rank"])
    last = [r[1:] for r in in_order(whole, "object_id", *names[:4]) if r[0] == "a"][-1]
    assert last == (2.0, 8.0, 6.0, 3.0)  # rows 2, 8, 5, 7; the newest, 7, is third
    with pytest.raises(ValueError, match="unknown rolling"):
        history.add_rolling_stats(two, (4,), ["mode"])


def test_rank_of_equal_values(panel):
    df = panel([("a", h, v) for h, v in enumerate([3.0, 1.0, 3.0, 0.0])])
    out = in_order(history.add_rolling_stats(df, (3,), ["rank"]), "rolling_rank_energy_kwh_3")
    assert out[-1] == (2.5,)


def test_averages_leave_out_the_last_rows(two):
    out = history.add_customer_averages(two, 2, (1,))
    found = [r[1:] for r in in_order(out, "object_id", "customer_mean_energy_kwh", "customer_1d_mean_energy_kwh") if r[0] == "a"]
    seen = [None, None] + [
        statistics.mean([v for v in VALUES[: i - 1] if v is not None]) for i in range(2, len(VALUES))
    ]
    assert [r[0] for r in found] == pytest.approx(seen)
    assert found[-1][0] == found[-1][1]


def test_trailing_days_forget(panel):
    df = panel([("a", h, float(h)) for h in range(60)])
    out = in_order(history.add_customer_averages(df, 24, (1,)), "customer_1d_mean_energy_kwh", "customer_mean_energy_kwh")
    assert out[23] == (None, None) and out[24] == (0.0, 0.0)
    assert out[59] == (pytest.approx(statistics.mean(range(12, 36))), pytest.approx(statistics.mean(range(36))))


def test_freeze_keeps_nulls_and_short_blocks(panel):
    df = panel([("a", h, v) for h, v in enumerate([None, 2.0, 3.0, 4.0, 5.0])])
    out = history.convert_to_multi_horizon(
        df.withColumnRenamed("energy_kwh", "lag_1").selectExpr("*", "lag_1 AS other"), 2, ["other"]
    )
    found = in_order(out, "horizon_index_2", "lag_1_frozen", "other_frozen", "forecast_origin_time")
    assert [r[0] for r in found] == [0, 1, 0, 1, 0]
    assert [r[1] for r in found] == [None, None, 3.0, 3.0, 5.0]
    assert [r[2] for r in found] == [r[1] for r in found]
    assert found[1][3] == datetime(2019, 12, 31, 23) and found[4][3] == datetime(2020, 1, 1, 3)


def test_no_feature_sees_its_own_row(panel):
    """Changing the newest reading changes no feature of its row."""

    def last(value):
        df = panel([("a", h, float(h % 7)) for h in range(40)] + [("a", 40, value)])
        df = history.add_rolling_stats(df, (6,), ["mean", "std"])
        df = history.add_lags(df, (1, 24))
        df = history.freeze_history_features(df, 24)
        df = history.add_customer_averages(df)
        return in_order(df.drop("energy_kwh"), *[c for c in df.columns if c != "energy_kwh"])[-1]

    assert last(0.0) == last(999.0)
