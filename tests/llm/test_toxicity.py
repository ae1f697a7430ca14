import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterframe.llm import toxicity
from meterframe.llm.folds import is_training
from meterframe.session import durable

WORDS = [a + b for a in "ba ke li mo nu ra so ti vo zu".split() for b in "lan mer pix ron ton tus".split()]


def corpus(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 8))]
        bad = i % 4 == 0
        if bad:
            k = rng.randrange(len(sentences))
            sentences[k] += f" you {rng.choice(['grolk', 'snarb', 'Blivvet'])}"
        docs.append((i, ". ".join(sentences).capitalize() + ".", 0.5))
        labels.append((i, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(1500, 1)
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    return frame, toxicity.fit(frame, known, is_training(F.col("doc_id"), 5))


def test_held_out_accuracy_and_sentences(spark, fitted):
    frame, model = fitted
    rows = toxicity.score(frame, model).where(~is_training(F.col("doc_id"), 5)).collect()
    assert len(rows) > 200
    right = sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows)
    assert right / len(rows) > 0.97
    texts = {r.doc_id: r.text for r in frame.collect()}
    for r in rows:
        if r.score >= 0.5 and r.doc_id % 4 == 0:
            worst = max(r.sentences, key=lambda s: s.score)
            assert any(w in texts[r.doc_id][worst.start : worst.end].lower() for w in ("grolk", "snarb", "blivvet"))


def test_score_is_the_noisy_or_of_sentences(fitted):
    model = fitted[1]
    weights = toxicity.Weights(model)
    text = "Balan mer ron. You grolk! Nutus\nkepix snarb"
    total, places = toxicity.score_text(text, weights)
    z = []
    for sentence in ("balan mer ron", "you grolk", "nutus", "kepix snarb"):
        z.append(model.bias + sum(model.weights[f] for w in set(sentence.split()) for f in toxicity.Features()[w]))
    plain = [1 / (1 + math.exp(-x)) for x in z]
    assert np.allclose([s for _, _, s in places], plain)
    assert math.isclose(total, 1 - math.prod(1 - s for s in plain), rel_tol=1e-9)


def test_odd_rows(spark, fitted):
    model = fitted[1]
    long = "balan mer. " * 30000
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "x"), (None, "you grolk", "x"), (3, "... 123 !", "x"), (4, long, "x")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, sentences string"), model).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    blank = model.squash(0.0)
    assert len(got) == 6 and by[1] == [blank, blank] and by[2] == [blank] and by[3] == [blank]
    assert by[None][0] > 0.5 and 0 <= by[4][0] <= 1


def test_filter_keeps_all_columns(spark, fitted):
    frame, model = fitted
    kept = toxicity.without_toxic(frame, model)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    scored = {r.doc_id for r in toxicity.score(frame, model).collect() if r.score < 0.5}
    assert ids == scored


def test_labels_without_both_classes_or_documents(spark):
    docs = spark.createDataFrame([(1, "balan", 0)], "doc_id long, text string, toxic int")
    for labels in ([], [(1, 1)], [(1, None)], [(9, 0), (None, 1)]):
        known = spark.createDataFrame(labels, "doc_id long, toxic int")
        model = toxicity.fit(docs, known, F.lit(True))
        assert toxicity.score(docs, model).first().score < 0.5
    empty = docs.limit(0)
    assert toxicity.score(empty, toxicity.fit(empty, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), F.lit(True))).collect() == []


def test_long_runs_of_text_do_not_learn_from_held_out_rows(spark):
    docs, labels = corpus(400, 5)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    train = is_training(F.col("doc_id"), 5)
    flipped = known.withColumn("toxic", F.when(train, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = toxicity.fit(frame, known, train), toxicity.fit(frame, flipped, train)
    assert np.allclose(a.weights, b.weights) and math.isclose(a.bias, b.bias, rel_tol=1e-9)


def test_length_alone_is_not_toxic(spark):
    """Some toxic labels have no sign in the text, as in the given tables."""
    docs, labels = corpus(1500, 1)
    labels = [(i, int(bad or i % 20 == 3)) for i, bad in labels]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double")
    model = toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    long = "balan mer. " * 30000
    rows = spark.createDataFrame([(1, long), (2, "balan mer. "), (3, long + "you grolk.")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(rows, model).collect()}
    assert scores[1] == scores[2] < 0.5 < scores[3]
    assert {r.doc_id for r in toxicity.without_toxic(rows, model).collect()} == {1, 2}


def test_large_and_repeated_rows_do_not_end_the_sample(spark):
    docs, labels = corpus(600, 3)
    huge = [(600, "Balan mer ron ton. " * 1_700_000, 0.5)]  # over eight million features
    again = [(5, f"nutus kepix. {i}", 0.5) for i in range(3000)]
    known = spark.createDataFrame(labels + [(600, 0)], "doc_id long, toxic int")
    frame = spark.createDataFrame(huge + again + docs, "doc_id long, text string, score double").coalesce(1)
    model = toxicity.fit(frame, known, F.lit(True))
    rows = toxicity.score(spark.createDataFrame(docs, "doc_id long, text string, score double"), model).collect()
    assert sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows) / len(rows) > 0.97
    sample = toxicity.labelled(frame, known, F.lit(True))
    assert sample.count() == sample.select("doc_id").distinct().count() == 601


def test_a_document_sends_a_bounded_share(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "DOC_FEATURES", 20)
    texts = [(1, 1, ". ".join(f"{a} {b}" for a in WORDS[:9] for b in WORDS[9:20])), (2, 0, "balan. " * 500 + "mer"), (3, 0, "...")]
    sample = spark.createDataFrame(texts, "doc_id long, toxic int, text string")
    rows = {r.doc_id: r for r in toxicity.sample_features(sample, np.ones(1 << toxicity.BITS, bool)).collect()}
    assert set(rows) == {1, 2} and 0 < len(rows[1].flat) <= 4 * 20
    assert sorted(np.frombuffer(rows[2].times, "<i4").tolist()) == [1, 500]


def test_rows_are_learned_from_whole_up_to_the_bound(spark, monkeypatch):
    texts = [(1, 1, ". ".join(f"{a} {b}" for a in WORDS[:30] for b in WORDS[30:])), (2, 0, "balan mer. nutus"), (3, 0, "..."), (4, 1, "kepix ron")]
    sample = spark.createDataFrame(texts, "doc_id long, toxic int, text string")
    features = toxicity.sample_features(sample, np.ones(1 << toxicity.BITS, bool))
    size = {r.doc_id: len(r.flat) // 4 for r in features.collect()}
    assert set(size) == {1, 2, 4} and size[1] > 1333
    assert {r.doc_id for r in toxicity.chosen(features).collect()} == {1, 2, 4}
    monkeypatch.setattr(toxicity, "SAMPLE_FEATURES", size[2] + size[4])  # the long row does not fit, and ends nothing
    assert {r.doc_id: len(r.flat) // 4 for r in toxicity.chosen(features).collect()} == {2: size[2], 4: size[4]}


def test_few_toxic_rows_of_a_small_table(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(WORDS) for _ in range(12)) + (". you grolk." if i < 5 else ".")) for i in range(200)]
    known = spark.createDataFrame([(i, int(i < 5)) for i in range(200)], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), known, F.lit(True))
    weights = toxicity.Weights(model)
    assert toxicity.score_text("balan mer. you grolk", weights)[0] > 0.5 > toxicity.score_text("balan mer. you", weights)[0]


def test_fit_against_a_dense_one(spark):
    """The same objective with full matrices, one row per sentence of each document."""
    docs, labels = corpus(400, 8)
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    table, y = toxicity.Features(), np.array([b for _, b in labels], float)
    parts = [[sorted({f for w in ws for f in table[w]}) for _, _, ws in toxicity.sentences(t)] for _, t, _ in docs]
    raw = [[sorted(f for w in ws for f in table[w]) for _, _, ws in toxicity.sentences(t)] for _, t, _ in docs]
    held = np.zeros((len(docs), 1 << toxicity.BITS), bool)
    for i, sentences in enumerate(parts):
        for fs in sentences:
            held[i, fs] = True
    n, bad, rate = held.sum(0), held[y > 0].sum(0), y.mean()
    z = np.abs(bad - n * rate) / np.sqrt(np.maximum(n, 1) * rate * (1 - rate))
    used = np.flatnonzero((n >= 2) & (z >= toxicity.LEAST_Z))
    x = [[np.array([fs.count(f) for f in used], float) for fs in sentences] for sentences in raw]
    of = np.array([i for i, sentences in enumerate(x) for r in sentences if r.any()])
    x = np.array([r for sentences in x for r in sentences if r.any()])
    prior = np.append(np.log((bad[used] + 1) / (n[used] - bad[used] + 1)) - np.log(rate / (1 - rate)), [-6.0, -6.0])
    member = (of[None, :] == np.arange(len(docs))[:, None]).astype(float)

    def loss_gradient(w):
        s = 1 / (1 + np.exp(-(x @ w[:-2] + w[-2])))
        leak = 1 / (1 + np.exp(-w[-1]))
        clean = (1 - leak) * np.exp(member @ np.log1p(-np.minimum(s, 1 - 1e-9)))
        p = np.clip(1 - clean, 1e-9, 1 - 1e-9)
        d_none = np.where(y > 0, (1 - p) / p, -1.0) / len(y)  # of the loss, by the log of ``clean``, with a minus
        d_z = -s * (member.T @ d_none)
        return np.concatenate([x.T @ d_z, [d_z.sum(), -leak * d_none.sum()]]) + toxicity.DECAY * (w - prior)

    w, m, v = prior.copy(), np.zeros_like(prior), np.zeros_like(prior)
    for step in range(1, toxicity.STEPS + 1):
        g = loss_gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - toxicity.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    assert set(np.flatnonzero(model.weights)) == set(used)
    assert np.allclose(model.weights[used], w[:-2], atol=1e-6)
    assert math.isclose(model.bias, w[-2], abs_tol=1e-6) and math.isclose(model.leak, 1 / (1 + math.exp(-w[-1])), abs_tol=1e-6)


def test_ids_of_the_sample_take_no_python_workers(spark):
    """An RDD of Python rows takes a daemon and workers of its own beside those of the operators."""
    sample = spark.createDataFrame([(1, 1, "balan mer"), (2, 0, "kepix ron")], "doc_id long, toxic int, text string")
    features = durable(toxicity.sample_features(sample, np.ones(1 << toxicity.BITS, bool)))
    assert "ExistingRDD" not in toxicity.chosen(features)._jdf.queryExecution().executedPlan().toString()
    assert toxicity.chosen(features.limit(0)).collect() == []


def test_scoring_keeps_each_word_once():
    weights = toxicity.Weights(toxicity.Model(np.ones(1 << toxicity.BITS), 0.0))
    assert weights["balan"] == 2.0 and weights["mer"] == 1.0
    assert not any(isinstance(held, toxicity.Features) for held in vars(weights).values())
