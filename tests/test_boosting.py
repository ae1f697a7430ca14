"""Trees grown from histograms against a plain grower that holds all rows."""

import math
import random

import numpy as np
import pytest

from meterframe.operators import boosting
from meterframe.operators.boosting import TreeSettings, fit_trees, predict_trees


def soft(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def grow(x, y, s):
    """Best-first growth of one meter's trees with a list of open leaves."""
    edges = [sorted({sorted(c[~np.isnan(c)])[max(math.ceil((i + 1) / s.bins * (~np.isnan(c)).sum()), 1) - 1] for i in range(s.bins)}) if (~np.isnan(c)).any() else [] for c in x.T]
    level = float(np.rint(y * 1e6).sum()) / len(y) / 1e6
    pred = np.full(len(y), level)
    out = []
    for tree in range(1, s.trees + 1):
        g = np.rint((y - pred) * 1e6)

        def score(rows):
            return soft(g[rows].sum() / 1e6, s.l1) ** 2 / (len(rows) + s.l2)

        def best(rows):
            found = None
            for f in range(x.shape[1]):
                c = x[rows, f]
                for e in edges[f]:
                    under = c <= e
                    if not any(e2 == e for e2 in np.array(edges[f])[np.searchsorted(edges[f], c[~np.isnan(c)])]):
                        continue  # an edge whose bin is empty here
                    missing = np.isnan(c)
                    for side in [True, False] if missing.any() else [bool(under.sum() * 2 >= len(rows))]:
                        left = under | (missing & side)
                        if min(left.sum(), (~left).sum()) < s.min_rows:
                            continue
                        gain = score(rows[left]) + score(rows[~left]) - score(rows)
                        if gain > 0 and (found is None or gain > found[0]):
                            found = (gain, f, e, side, rows[left], rows[~left])
            return found

        leaves = {1: (np.arange(len(y)), best(np.arange(len(y))))}
        splits = []
        while len(leaves) < s.leaves:
            open_ = {k: v[1] for k, v in leaves.items() if v[1] and k < 2**s.depth}
            if not open_:
                break
            node = max(open_, key=lambda k: (open_[k][0], -k))
            gain, f, e, side, left, right = open_[node]
            del leaves[node]
            splits.append((tree, node, f, e, side, gain))
            for child, rows in ((2 * node, left), (2 * node + 1, right)):
                leaves[child] = (rows, best(rows))
        if not splits:
            break
        for node, (rows, _) in leaves.items():
            value = soft(g[rows].sum() / 1e6, s.l1) / (len(rows) + s.l2) * s.step
            pred[rows] += value
            out.append((tree, node, None, None, None, None, value))
        out += [(*x_, None) for x_ in splits]
    return level, sorted(out, key=lambda n: n[:2]), pred


def panel(seed, sizes=(260, 90, 9)):
    rng = random.Random(seed)
    rows = []
    for meter, n in enumerate(sizes):
        for i in range(n):
            a = rng.choice([None, rng.random(), rng.randint(0, 3) / 1.0])
            b = rng.random() * 10
            y = (3.0 if a is None else 2.0 * a) * (1 if b > 4 else -1) + rng.gauss(0, 0.3)
            rows.append((f"m{meter}", i, a, b, float("nan") if i % 7 == 0 else b * b, y if rng.random() > 0.03 else None))
    return rows


SCHEMA = "object_id string, timestamp int, a double, b double, c double, y double"


@pytest.mark.parametrize(
    "settings",
    [
        TreeSettings(trees=3, step=0.3, leaves=6, depth=4, min_rows=5),
        TreeSettings(trees=2, step=0.5, leaves=32, depth=3, min_rows=3, l1=0.0, l2=0.0),
        TreeSettings(trees=2, step=1.0, leaves=3, depth=12, min_rows=10, l1=2.0, l2=5.0, bins=16),
    ],
)
def test_equals_plain_grower(spark, settings, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 60)  # several blocks a meter
    rows = panel(settings.leaves)
    df = spark.createDataFrame(rows, SCHEMA)
    models = fit_trees(df, ["a", "b", "c"], "y", settings=settings)
    got = {m.object_id: m for m in models.collect()}
    predicted = {(r.object_id, r.timestamp): r.y_pred for r in predict_trees(models, df, ["a", "b", "c"], "y").collect()}
    assert len(predicted) == len(rows)
    for meter in ("m0", "m1", "m2"):
        mine = [r for r in rows if r[0] == meter and r[-1] is not None]
        x = np.array([[math.nan if v is None else v for v in r[2:5]] for r in mine])
        level, nodes, pred = grow(x, np.array([r[-1] for r in mine]), settings)
        assert got[meter].level == pytest.approx(level, abs=1e-9)
        plain = [(n.tree, n.node, n.feature, n.threshold, n.missing_left, n.gain, n.value) for n in got[meter].nodes]
        assert [n[:5] for n in plain] == [n[:5] for n in nodes]
        for p, q in zip(plain, nodes):
            assert p[5:] == (pytest.approx(q[5], abs=1e-6), pytest.approx(q[6], abs=1e-9))
        for r, p in zip(mine, pred):
            assert predicted[meter, r[1]] == pytest.approx(p, abs=1e-9)


def test_few_rows_give_the_mean(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1.0, 1.0, 2.0), ("a", 2, 1.0, 1.0, 1.0, 4.0), ("b", 1, None, None, None, None)], SCHEMA)
    models = fit_trees(df, ["a", "b"], "y", settings=TreeSettings(trees=2))
    assert [(m.object_id, m.level, m.nodes) for m in models.collect()] == [("a", 3.0, [])]
    assert sorted((r.object_id, r.y_pred) for r in predict_trees(models, df, ["a", "b"], "y").collect()) == [("a", 3.0), ("a", 3.0)]


def test_settings_are_checked():
    with pytest.raises(ValueError):
        TreeSettings(bins=300)


def test_model_run_with_trees_and_dev(spark, tmp_path):
    from meterframe.plans.runs import model_run

    rows = panel(3, (60, 40))
    df = spark.createDataFrame(rows, SCHEMA)
    train, dev, test = df.where("timestamp < 20"), df.where("timestamp between 20 and 29"), df.where("timestamp >= 30")
    settings = TreeSettings(trees=2, leaves=3, min_rows=4)
    run = model_run(train, test, ["a", "b"], str(tmp_path), target="y", trees=settings, dev=dev)
    assert run.forecasts.count() == sum(r[1] >= 30 for r in rows)
    assert {r.model for r in run.forecasts.select("model").distinct().collect()} == {"trees"}
    stored = {r.key: float(r.value) for r in spark.read.parquet(f"{tmp_path}/metrics").collect()}
    assert set(stored) == {f"{p}{m}_average" for p in ("", "dev_") for m in ("MAE", "RMSE", "sMAPE")}
    assert stored["dev_MAE_average"] == pytest.approx(run.dev_metrics.first()[0])
    params = {r.param: r.value for r in spark.read.parquet(f"{tmp_path}/params").collect()}
    assert params["trees.leaves"] == "3" and params["trees.step"] == "0.05"


def test_histograms_of_many_blocks_come_a_few_blocks_at_a_time():
    """A batch of many small blocks is not turned to rows as a whole."""
    import pyarrow as pa

    class Blocks:
        dtypes = [("object_id", "string")]

        def mapInArrow(self, run, schema):
            return run

    rng = np.random.default_rng(3)
    n, rows, width = 2000, 12, 3
    bins = rng.integers(0, 9, (n, rows, width)).astype(np.uint8)
    y = rng.normal(size=(n, rows))
    split = pa.list_(pa.struct([("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("missing_left", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([f"m{i}" for i in range(n)]), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array([v.tobytes() for v in y], pa.binary()),
            pa.array([np.zeros(rows).tobytes()] * n, pa.binary()), pa.array([[]] * n, split), pa.array([[1]] * n, pa.list_(pa.int64())),
        ],
        ["object_id", "bins", "y", "pred", "splits", "wanted"],
    )
    found = list(boosting._block_histograms(Blocks(), width, "object_id")(iter([batch])))
    assert max(b.num_rows for b in found) <= boosting.SLICE_BLOCKS * rows * width
    got = {(r["object_id"], r["feature"], r["bin"]): (r["g"], r["n"]) for b in found for r in b.to_pylist()}
    assert sum(b.num_rows for b in found) == len(got)
    for i in (0, 255, 256, 1999):
        for f in range(width):
            for b in set(bins[i, :, f].tolist()):
                here = bins[i, :, f] == b
                assert got[(f"m{i}", f, b)] == (int(np.rint(y[i][here] * 1e6).sum()), int(here.sum()))
