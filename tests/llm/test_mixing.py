import hashlib
import math

from pyspark.sql import functions as F

from meterframe.llm import mixing


def uniform(*parts):
    text = ":".join("null" if p is None else str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / (1 << 52)


def quantile(u, rate):
    term = total = math.exp(-rate)
    k = 0
    while total <= u and k < mixing.STEPS:
        k += 1
        term = term * rate / k
        total += term
    return k


def brute(rows, weight, seed):
    n = {}
    for _, source in rows:
        n[source] = n.get(source, 0) + 1
    whole = sum(weight(s, c) for s, c in n.items())
    out = {}
    for i, source in rows:
        rate = weight(source, n[source]) / whole * len(rows) / n[source]
        parts = math.ceil(max(rate / mixing.MAX_RATE, 1.0))
        copies = sum(quantile(uniform(seed, "n", j, i), rate / parts) for j in range(1, parts + 1)) if rate > 0 else 0
        for c in range(copies):
            out[(i, source, c)] = out.get((i, source, c), 0) + 1
    return out


def counted(df):
    out = {}
    for r in df.collect():
        key = (r.doc_id, r.source, r.copy_no)
        out[key] = out.get(key, 0) + 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, s, "t", 5.0, "old") for i, s in rows], "doc_id long, source string, text string, _n double, mix_key string")


ROWS = [(i, "big") for i in range(900)] + [(1000 + i, f"s{i % 3}") for i in range(90)] + [(None, None), (None, None), (7, "big"), (5000, "tiny")]


def test_counts_are_the_quantiles(spark):
    got = mixing.mix(frame(spark, ROWS), mixing.tempered(0.0), seed=4)
    assert counted(got) == brute(ROWS, lambda s, n: 1.0, 4)
    assert got.columns == ["doc_id", "source", "text", "_n", "copy_no", "mix_key"]


def test_rates_near_targets(spark):
    rows = [(i, "a" if i < 3000 else "b") for i in range(4000)]
    got = mixing.mix(frame(spark, rows), F.when(F.col("source") == "a", 1.0).otherwise(3.0), seed=1).groupBy("source").count().collect()
    sizes = {r.source: r["count"] for r in got}
    assert abs(sizes["a"] - 1000) < 150 and abs(sizes["b"] - 3000) < 260


def test_order_is_global_and_sources_without_weight_go(spark):
    got = mixing.mix(frame(spark, ROWS), F.when(F.col("source") != "big", 1.0), seed=2).collect()
    assert [r.mix_key for r in got] == sorted(r.mix_key for r in got)
    assert got and {r.source for r in got} <= {"s0", "s1", "s2", "tiny"}


def test_large_table_of_sources_gives_the_same_rows(spark, monkeypatch):
    one = counted(mixing.mix(frame(spark, ROWS), mixing.tempered(0.5)))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert counted(mixing.mix(frame(spark, ROWS), mixing.tempered(0.5))) == one


def test_empty_table(spark):
    assert mixing.mix(frame(spark, []), mixing.tempered(0.5)).collect() == []


def test_counts_are_looked_up_in_sums_of_the_source(spark):
    """Of every number of copies up to the last, and a number above all sums."""
    rates = [0.001, 0.7, 3.3, mixing.MAX_RATE]
    rows = spark.createDataFrame([(r,) for r in rates], "rate double").select("rate", mixing.poisson_sums(F.col("rate")).alias("sums")).collect()
    for row in rows:
        assert len(row.sums) == mixing.STEPS
        for u in [k / 97 for k in range(97)] + [1 - 2.0**-52, *row.sums[:12]]:
            assert next((k for k, t in enumerate(row.sums) if t > u), mixing.STEPS) == quantile(u, row.rate)
