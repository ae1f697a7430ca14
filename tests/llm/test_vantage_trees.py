import numpy as np
import pytest
from pyspark.sql import functions as F

from meterframe.llm import vantage_trees


def vectors(n, size, seed, clusters=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, size))
    return centers[rng.integers(clusters, size=n)] + 0.3 * rng.normal(size=(n, size))


def brute(rows, k):
    """Of (id, vector) rows, the k nearest of each id divisible by 5."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % 5 == 0:
            found = {}
            for j, c in good:
                if j != i and len(c) == len(q):
                    s = float((q * c).sum() / np.sqrt((q * q).sum() * (c * c).sum()))
                    found[j] = max(s, found.get(j, -2.0))
            out[i] = sorted(found.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def searched(spark, rows, k=3, factor=1.0):
    df = spark.createDataFrame([(i, v, 0.0) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(3)
    out = {}
    for r in vantage_trees.nearest(vantage_trees.usable(df), F.col("vec_id") % 5 == 0, k, factor).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def same(got, truth):
    assert set(got) == {q for q, found in truth.items() if found}
    for q, found in got.items():
        assert [i for i, _ in found] == [i for i, _ in truth[q]]
        assert np.allclose([s for _, s in found], [s for _, s in truth[q]], rtol=0, atol=1e-14)


@pytest.mark.parametrize("size,clusters", [(2, 1), (8, 6), (24, 400)])
def test_factor_one_is_exact(spark, monkeypatch, size, clusters):
    monkeypatch.setattr(vantage_trees, "LEAF", 5)
    monkeypatch.setattr(vantage_trees, "SHARD_NUMBERS", 120 * size)
    monkeypatch.setattr(vantage_trees, "BLOCK_NUMBERS", 30 * size)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(600, size, size, clusters))]
    same(searched(spark, rows), brute(rows, 3))


def test_relaxed_search_finds_most(spark, monkeypatch):
    monkeypatch.setattr(vantage_trees, "LEAF", 8)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(1500, 16, 3))]
    truth = brute(rows, 5)
    got = searched(spark, rows, 5, 0.5)
    hits = sum(len({i for i, _ in truth[q]} & {i for i, _ in got[q]}) for q in truth)
    assert hits / sum(map(len, truth.values())) >= 0.9


def test_copies_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vantage_trees, "LEAF", 3)
    monkeypatch.setattr(vantage_trees, "SHARD_NUMBERS", 60)
    hot = [1.0, 2.0, -1.0]
    rows = [(i, hot) for i in range(200)] + [(200 + i, v.tolist()) for i, v in enumerate(vectors(50, 3, 1))]
    rows += [(300, None), (305, []), (310, [0.0, 0.0, 0.0]), (315, [1.0, None, 0.0]), (320, [1.0, float("nan"), 0.0]), (325, [1.0, float("inf"), 0.0])]
    rows += [(None, hot), (330, [1.0, 0.0]), (331, [0.5, 0.1]), (335, [1e200, 2e200, -1e200]), (340, [1e-200, 2e-200, 3e-200]), (345, [4.0])]
    got = searched(spark, rows)
    wide = {q: f for q, f in brute([r for r in rows if r[0] not in (335, 340)], 3).items()}
    for q in (0, 5, 195, 330):
        assert [i for i, _ in got[q]] == [i for i, _ in wide[q]]
    assert [i for i, _ in got[335]] == [0, 1, 2] and got[335][0][1] == pytest.approx(1.0)
    assert not {300, 305, 310, 315, 320, 325, 345} & set(got) and 340 in got


def test_repeated_rows(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [1.0, 0.1]), (2, [0.0, 1.0])]
    same(searched(spark, rows), brute(rows, 3))


def test_many_rows_of_one_id(spark):
    """k + 2 copies of rows and more, and one id with many near vectors."""
    rows = [(i, [1.0, 0.1]) for i in (7, 8, 9, 10, 11) for _ in range(5)] + [(0, [1.0, 0.1])] * 6 + [(5, [1.0, 0.0])] * 5
    rows += [(3, [1.0, 0.001 * i]) for i in range(1, 40)] + [(5, [1.0, -0.0001 * i]) for i in range(1, 20)] + [(4, [0.3, 1.0]), (6, [0.0, 1.0])]
    for k in (3, 5):
        same(searched(spark, rows, k), brute_of_greatest(rows, k))


def test_ties_go_to_the_smaller_id_however_many(spark, monkeypatch):
    """Vectors of one direction, and small whole numbers with many equal cosines."""
    line = [(i, [2.0 * i + 1.0, 0.0]) for i in range(60)]
    got = searched(spark, line, 5)
    for q in (0, 5, 55):
        assert [i for i, _ in got[q]] == [i for i in range(6) if i != q][:5]
    rng = np.random.default_rng(9)
    bits = [(i, v.tolist()) for i, v in enumerate(rng.integers(0, 2, (700, 12)).astype(float)) if v.any()]
    same(searched(spark, bits, 5), brute(bits, 5))
    monkeypatch.setattr(vantage_trees, "SHARD_NUMBERS", 800)
    same(searched(spark, bits, 5), brute(bits, 5))


def brute_of_greatest(rows, k):
    """As ``brute``; as a query the greatest vector of an id counts."""
    out = {}
    for q in {i for i, _ in rows if i % 5 == 0}:
        asked = max(v for i, v in rows if i == q)
        out |= {q: brute([(i, v) for i, v in rows if i != q] + [(q, asked)], k)[q]}
    return out


def test_empty_table_and_factor(spark):
    assert searched(spark, []) == {}
    with pytest.raises(ValueError):
        searched(spark, [(5, [1.0])], factor=0.0)
