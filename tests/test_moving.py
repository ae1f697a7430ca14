"""Fits from stored sums equal fits of the rows."""

import numpy as np
import pytest

from meterframe.operators import models
from meterframe.operators.moving import MovingRidge
from meterframe.session import fresh_path

FEATURES = ["u", "v", "w"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    out = []
    for meter in ("a", "b", "late"):
        for i in range(80):
            p = i // 20
            if meter == "late" and p < 2:
                continue
            u, v = rng.normal(50 * p, 1), rng.normal()
            w = 5.0 * p  # constant within a period, not across them
            y = 3 * u - 2 * v + w + rng.normal(0, 0.1)
            out.append((meter, p, None if rng.random() < 0.1 else u, v, w, None if i % 17 == 0 else y))
    return spark.createDataFrame(out, "object_id string, p int, u double, v double, w double, y double")


def moving(spark, rows, periods=range(4)):
    made = MovingRidge(spark, fresh_path(spark, "moving"), FEATURES, "y")
    for p in periods:
        assert made.add(rows.where(f"p = {p}"), str(p))
    return made


def by_meter(fitted):
    return {r.object_id: r for r in fitted.collect()}


@pytest.mark.parametrize("span, penalty", [((0, 1, 2), 1.0), ((1, 2, 3), 1.0), ((2, 3), 0.0), ((3,), 1.0)])
def test_spans_equal_full_fits(spark, rows, span, penalty):
    made = moving(spark, rows)
    got = by_meter(made.fit([str(p) for p in span], penalty))
    expected = by_meter(models.fit_ridge(rows.where(f"p in ({','.join(map(str, span))})"), FEATURES, "y", penalty=penalty))
    assert got.keys() == expected.keys()
    for meter, want in expected.items():
        assert got[meter].rows == want.rows
        np.testing.assert_allclose(got[meter].weights, want.weights, rtol=1e-6, atol=1e-8)
        np.testing.assert_allclose(got[meter].means, want.means, rtol=1e-9)
        np.testing.assert_allclose([got[meter].level, got[meter].intercept], [want.level, want.intercept], rtol=1e-6)


def test_periods_are_added_once_and_rows_not_read_again(spark, rows):
    made = moving(spark, rows, (0, 1))
    assert not made.add(rows.where("p = 3"), "1")
    fitted = made.fit(["0", "1"])
    assert all("/sums/" in f or "/centres/" in f for f in fitted.inputFiles())
    with pytest.raises(ValueError, match="'9'"):
        made.fit(["0", "9"])
    with pytest.raises(ValueError, match="none"):
        made.fit([])


def test_a_period_that_was_cut_off(spark, rows, monkeypatch):
    from meterframe.operators import moving as module

    made = moving(spark, rows, (0,))
    with monkeypatch.context() as m:
        m.setattr(module, "create_once", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            made.add(rows.where("p = 1"), "1")
    assert made.periods() == ["0"]
    assert made.add(rows.where("p = 1"), "1")
    assert {m: r.rows for m, r in by_meter(made.fit_stored(["0", "1"])).items()} == {
        m: r.rows for m, r in by_meter(models.fit_ridge(rows.where("p < 2"), FEATURES, "y")).items()
    }


def test_values_that_are_missing_throughout(spark):
    rows = spark.createDataFrame([("a", 1.0, None, 2.0), ("a", 2.0, None, 4.0), ("a", 3.0, None, 6.0), (None, 1.0, 1.0, 1.0)],
                                 "object_id string, u double, v double, y double")
    made = MovingRidge(spark, fresh_path(spark, "moving"), ["u", "v"], "y")
    made.add(rows.limit(0), "0")
    made.add(rows, "1")
    (one,) = made.fit(["0", "1"], 0.0).collect()
    np.testing.assert_allclose(one.weights, [2.0, 0.0])
    assert one.means == [2.0, None]
