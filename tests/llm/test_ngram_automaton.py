import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterframe.llm import ngram_automaton
from meterframe.llm.folds import is_training


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute(rows, order, strength=ngram_automaton.STRENGTH):
    """Scores by the recursive formula, with exact n-grams in dictionaries."""
    train = [zlib.crc32(str("" if i is None else i).encode()) % 10 != 0 for i, _ in rows]
    grams = Counter()
    for (_, text), t in zip(rows, train):
        words = tokens(text)
        for k in range(1, order + 1):
            grams.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1) if t)
    n = sum(c for g, c in grams.items() if len(g) == 1)
    v = sum(len(g) == 1 for g in grams)

    def p(history, word):
        if not history:
            return (grams[(word,)] + 0.1) / (n + 0.1 * (v + 1))
        lower = p(history[1:], word)
        if not grams[history]:
            return lower
        return (grams[(*history, word)] + strength * lower) / (grams[history] + strength)

    out = []
    for (i, text), t in zip(rows, train):
        words = tokens(text)
        full = sum(math.log10(p(tuple(words[max(0, k - order + 1) : k]), w)) for k, w in enumerate(words))
        base = sum(math.log10(p((), w)) for w in words)
        out.append((i, not t, len(words), sum(grams[(w,)] > 0 for w in words), n, round(base, 6), round(full, 6)))
    return sorted(out, key=str)


def scored(spark, rows, order):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = ngram_automaton.score(docs, is_training(F.col("doc_id"), 10), order)
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("a b c d e A É é the of x1".split()) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    return rows + [(7, "a b c"), (7, "a b c"), (61, None), (62, ""), (None, "only here"), (63, "\x1cq \x0b a\tb\n")]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_are_those_of_the_formula(spark, order):
    rows = corpus(order)
    assert scored(spark, rows, order) == brute(rows, order)


def test_small_blocks_and_buckets_change_nothing(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(ngram_automaton, "BLOCK_TOKENS", 9)  # cuts texts, too
    monkeypatch.setattr(ngram_automaton, "BUCKET_GRAMS", 50)
    assert scored(spark, rows, 3) == brute(rows, 3)


def test_without_training_texts(spark):
    rows = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    assert len(rows) > 3 and scored(spark, rows, 2) == brute(rows, 2)
    assert scored(spark, [], 2) == []


def test_probabilities_of_an_automaton_add_up_to_one():
    """From every state, over all words of a block and one unknown word."""
    import numpy as np

    words = np.unique(np.random.default_rng(1).integers(1, 2**63, 9).astype(np.uint64))
    tokens = np.random.default_rng(2).integers(0, 8, 400)  # the last word is unknown
    row = {"words": ngram_automaton.planes(words), "tokens": ngram_automaton.packed(np.append(tokens, 8).astype("<u4")), "sizes": [400, 1], "lead": [0, 0], "train": [True, False]}
    grams = ngram_automaton.Grams(row, 3)
    counts = [grams.counts(level).astype(float) for level in range(3)]
    machine = ngram_automaton.Automaton(grams, counts, 400, 8, 5.0)
    last = tokens[-1:].tolist()
    for history in ([], [0], [3, 4], [8], [int(tokens[0]), int(tokens[1])]):
        if history[-1:] == last:
            continue  # the last token has no follower in the text
        total = sum(10 ** machine.read([*history, w], len(history)) for w in range(9))
        assert math.isclose(total, 1.0, rel_tol=0.02 if history else 1e-9)
