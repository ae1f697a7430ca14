import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import in_order
from meterframe.functions.exact import Limbs
from meterframe.operators import history


def any_doubles(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        v = rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-9, 16)
        out.append(rng.choice([v, v, v, 1e16, -1e16, 0.0, None, float("nan"), float("inf"), 0.1]))
    return out


def exact_mean(values):
    kept = [Fraction(v) for v in values if v is not None and math.isfinite(v)]
    return float(sum(kept) / len(kept)) if kept else None


@pytest.mark.parametrize("seed, low, high", [(1, 1e-9, 1e16), (2, 5e-324, 1e-300), (3, 1.0, 1.7e308), (4, 0.25, 3.0)])
def test_limbs_hold_every_bit(spark, seed, low, high):
    rng = random.Random(seed)
    values = [rng.choice([1, -1]) * math.exp(rng.uniform(math.log(max(low, 1e-323)), math.log(high))) for _ in range(200)] + [low, -low, high, -high, 0.0]
    scale = Limbs.between(low, high)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", F.array(*scale.limbs(F.col("v"))).alias("limbs")).collect():
        assert all(0 <= x < 2**32 for x in row.limbs[:-1]) and abs(row.limbs[-1]) < 2**31
        assert sum(Fraction(x) * Fraction(2) ** (scale.low + 32 * i) for i, x in enumerate(row.limbs)) == Fraction(row.v)


def test_means_of_any_doubles(spark, panel):
    """Within one last place of the exact mean, whatever the other rows hold."""
    values = {m: any_doubles(k, size) for k, (m, size) in enumerate((("a", 160), ("b", 40), ("c", 3)))}
    df = panel([(m, h, v) for m, vs in values.items() for h, v in enumerate(vs)])
    names = ["customer_mean_energy_kwh", "customer_1d_mean_energy_kwh", "customer_2d_mean_energy_kwh"]
    got = in_order(history.add_customer_averages(df, 24, (1, 2)), *names)
    expected = []
    for m in sorted(values):
        vs = values[m]
        for i in range(len(vs)):
            expected.append(tuple(exact_mean(vs[low : max(i - 23, 0)]) for low in (0, max(i - 47, 0), max(i - 71, 0))))
    for row, wanted in zip(got, expected):
        for x, y in zip(row, wanted):
            assert (x is None) == (y is None)
            # The sum has one rounding a limb, the division one more.
            assert x is None or abs(x - y) <= 4 * math.ulp(y)


def test_cut_and_order_do_not_show(spark, panel):
    values = any_doubles(7, 300)
    df = panel([("a", h, v) for h, v in enumerate(values)] + [("b", h, 0.1 * h) for h in range(30)])
    names = ["customer_mean_energy_kwh", "customer_1d_mean_energy_kwh"]

    def bits(**options):
        return [tuple(None if x is None else x.hex() for x in r) for r in in_order(history.add_customer_averages(df.repartition(options.pop("parts", 1)), 24, (1,), **options), *names)]

    assert bits() == bits(part_rows=60) == bits(part_rows=31, parts=5)


def test_no_readings(spark, panel):
    df = panel([("a", h, None) for h in range(40)])
    assert set(in_order(history.add_customer_averages(df, 24, (1,)), "customer_mean_energy_kwh")) == {(None,)}
