"""Toxic documents and the sentences that make them so.

A sentence's score is a logistic function of its words and word beginnings; a
document is toxic if one of its sentences is, so its score is the noisy-or
``1 - (1 - leak) * prod(1 - s)`` over the sentences with a feature that has a
weight.  Other sentences say nothing, however many they are; the leak is the
chance that a document is labelled toxic without a sign in its text.  Only
documents carry labels; weights and leak are trained on the noisy-or by
gradient steps, which puts the blame on sentences.

``fit`` learns from at most ``SAMPLE_ROWS`` labelled documents, those of least
hash of their id, each cut into sentence features inside Spark tasks.  Features
that fewer than ``least_docs`` sample documents hold (one in a thousand, at least
two), or whose documents are toxic about as often as others, have no weight; this
is counted over whole texts.  Only the other features come to the driver, sentences
with the same ones once with their number.  A document is learned from whole or not
at all: in the order of the hash, those are taken with which the sample has at most
``SAMPLE_FEATURES`` features, so that one that does not fit does not end it.  (With
``DOC_FEATURES`` set, longer ones send their sentences of least hash instead.)
The model has a fixed size, ``2 ** BITS`` weights.  ``score`` reads every whole text.

Texts that are null or empty have no sentence and score the sentence bias
alone.  Rows are answered one by one, also repeated ones; of rows with the same
``doc_id`` one is learned from, that of the least text hash; ``label``s that are
null, and label rows without a document, are not learned from; several label
rows of one document count as the largest.  Without both labels among the rows
the model scores every text 0.  Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterframe.session import durable

BITS = 18
BEGINNINGS = (4,)  # letters; words of at least so many have these features too
SAMPLE_ROWS = 6_000
SAMPLE_FEATURES = 8_000_000
DOC_FEATURES: int | None = None
LEAST_Z = 4.5  # standard deviations between a feature's toxic documents and chance
STEPS, RATE, DECAY = 200, 0.1, 1e-3
CACHED_WORDS = 200_000
SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]?")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    weights: np.ndarray  # of 2 ** BITS features
    bias: float
    leak: float = 0.0  # of a document

    def squash(self, z: float) -> float:
        return 1 / (1 + math.exp(-min(max(z + self.bias, -30.0), 30.0)))


def features_of(word: str) -> tuple[int, ...]:
    """Feature numbers of a lower-case word: the word and its beginnings."""
    names = [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) >= n]]
    return tuple([xxhash.xxh3_64_intdigest(n) & ((1 << BITS) - 1) for n in names])


class Features(dict):
    """Feature numbers of words, looked up in a table of bounded size."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = features_of(word)
        if len(word) < 64:
            self[word] = found
        return found


class Weights(dict):
    """What a lower-case word adds to a sentence."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = float(sum([self.model.weights[f] for f in features_of(word)]))
        if len(word) < 64:
            self[word] = found
        return found


def sentences(text: str):
    """(start, end, distinct lower-case words) of each sentence: up to and with
    a full stop, exclamation or question mark or line end.  Pieces without a
    letter are left out."""
    for m in SENTENCE.finditer(text):
        words = set(WORD.findall(m[0].lower()))
        if words:
            yield m.start(), m.end(), words


def score_text(text: str | None, weights: Weights) -> tuple[float, list[tuple[int, int, float]]]:
    """The document's score and (start, end, score) of its sentences."""
    squash = weights.model.squash
    found, signs = [], [weights.model.leak]
    for a, b, words in sentences(text or ""):
        adds = [weights[w] for w in sorted(words)]
        found.append((a, b, squash(sum(adds))))
        if any(adds):
            signs.append(found[-1][2])
    return noisy_or(signs if found else [squash(0.0)]), found


def noisy_or(scores: list[float]) -> float:
    return -math.expm1(math.fsum([math.log1p(-min(s, 1 - 1e-12)) for s in scores]))


def labelled(docs: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """(doc_id, toxic, text) of the bounded sample.  ``train`` is over doc_id."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null")
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic")).withColumnRenamed("_id", "doc_id").where(train)
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).withColumnRenamed("doc_id", "_id")
    # The sample has a fixed bound, so the other documents need not move.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))


def least_docs(rows: float) -> float:
    return max(2, rows / 1000)


def feature_counts(sample: DataFrame) -> DataFrame:
    """Per feature the sample documents that hold it, and the toxic ones among
    them; as feature -1, all documents with a sentence."""

    def run(batches):
        table = Features()
        n, bad = np.zeros((1 << BITS) + 1, np.int64), np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = {w for _, _, ws in sentences(text.as_py() or "") for w in ws}
                if words:
                    held = list({f + 1 for w in words for f in table[w]} | {0})
                    n[held] += 1
                    bad[held] += label > 0
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at - 1), pa.array(n[at]), pa.array(bad[at])], ["feature", "n", "toxic"])

    counts = sample.select("text", "toxic").mapInArrow(run, "feature bigint, n bigint, toxic bigint")
    return counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def sample_features(sample: DataFrame, keep: np.ndarray) -> DataFrame:
    """Per sample document with a sentence: doc_id, toxic, and the kept features
    of its sentences one after the other, with their counts and how many
    sentences have just these."""
    shared = sample.sparkSession.sparkContext.broadcast(keep)
    names = ["doc_id", "toxic", "flat", "counts", "times"]

    def share(found: dict[bytes, int]) -> list[bytes]:
        sets = sorted(found, key=lambda b: (xxhash.xxh3_64_intdigest(b), b))
        if DOC_FEATURES is None:
            return sets
        ends = np.cumsum([len(b) // 4 for b in sets])
        return sets[: max(int(np.searchsorted(ends, DOC_FEATURES, "right")), 1)]

    def run(batches):
        table, keep = Features(), shared.value
        for batch in batches:
            out = []
            for doc_id, label, text in zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(), batch.column("text")):
                found, any_sentence = {}, False
                for _, _, words in sentences(text.as_py() or ""):
                    any_sentence = True
                    fs = np.sort(np.array([f for w in words for f in table[w] if keep[f]], "<i4")).tobytes()
                    if fs:
                        found[fs] = found.get(fs, 0) + 1
                if any_sentence:
                    sets = share(found)
                    counts, times = [len(b) // 4 for b in sets], [found[b] for b in sets]
                    out.append((doc_id, label, b"".join(sets), np.array(counts, "<i4").tobytes(), np.array(times, "<i4").tobytes()))
            columns = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    rows = sample.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic", "text")
    return rows.mapInArrow(run, "doc_id bigint, toxic int, flat binary, counts binary, times binary")


def chosen(features: DataFrame) -> DataFrame:
    """The rows of the sample, in the order of their ids' hash, with which it has at
    most ``SAMPLE_FEATURES`` features."""
    sizes = features.select("doc_id", F.xxhash64("doc_id").alias("h"), (F.length("flat") / 4).cast("bigint").alias("n"))
    left, ids = SAMPLE_FEATURES, []
    for r in sorted(sizes.collect(), key=lambda r: (r["h"], r["doc_id"])):  # at most SAMPLE_ROWS rows
        if r["n"] <= left:
            left -= r["n"]
            ids.append(r["doc_id"])
    # As an Arrow table, ids need no Python workers of another kind beside the others.
    there = features.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(ids, pa.int64())}))
    return features.join(F.broadcast(there), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, train: Column) -> Model:
    sample = durable(labelled(docs, labels, train), "sample")  # at most SAMPLE_ROWS texts
    counted = feature_counts(sample).toArrow()  # at most 2 ** BITS + 1 rows
    n, toxic = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    at = counted.column("feature").to_numpy() + 1
    n[at], toxic[at] = counted.column("n").to_numpy(), counted.column("toxic").to_numpy()
    empty = Model(np.zeros(1 << BITS), -30.0)
    if not 0 < toxic[0] < n[0]:
        return empty
    rows_in_all, rate, n, toxic = n[0], toxic[0] / n[0], n[1:], toxic[1:]
    z = np.abs(toxic - n * rate) / np.sqrt(np.maximum(n, 1) * rate * (1 - rate))
    odds = np.log((toxic + 1) / (n - toxic + 1)) - np.log(rate / (1 - rate))
    features = durable(sample_features(sample, (n >= least_docs(rows_in_all)) & (z >= LEAST_Z)), "features")
    rows = sorted(chosen(features).toArrow().to_pylist(), key=lambda r: r["doc_id"])
    if not rows:
        return empty
    y = np.array([r["toxic"] > 0 for r in rows], float)
    flat, per_sentence, times = [np.concatenate([np.frombuffer(r[c], "<i4") for r in rows]).astype(np.int64) for c in ("flat", "counts", "times")]
    doc_of = np.repeat(np.arange(len(rows)), [len(r["counts"]) // 4 for r in rows])
    return train_noisy_or(flat, np.repeat(np.arange(len(per_sentence)), per_sentence), doc_of, times, y, odds)


def train_noisy_or(feature: np.ndarray, sentence: np.ndarray, doc: np.ndarray, times: np.ndarray, y: np.ndarray, odds: np.ndarray) -> Model:
    """Adam on the mean log loss of the noisy-or.  ``feature`` i belongs to
    sentence ``sentence`` i, sentence j stands ``times`` j times in document
    ``doc`` j; all have features.  Weights start at, and are drawn to, how much
    likelier the feature is in toxic documents."""
    used, feature = np.unique(feature, return_inverse=True)
    n_sentences, n_docs = len(doc), len(y)
    prior = np.append(odds[used], [-6.0, -6.0])  # the last are the bias and the leak's
    w, m, v = prior.copy(), np.zeros_like(prior), np.zeros_like(prior)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, w[:-2][feature], n_sentences) + w[-2]
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        leak = 1 / (1 + math.exp(-min(max(w[-1], -30.0), 30.0)))
        none = np.bincount(doc, times * np.log1p(-np.minimum(s, 1 - 1e-9)), n_docs) + math.log1p(-leak)  # log chance of no toxic sentence
        p = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: s for a clean document, -s (1 - p) / p for a toxic one
        by_doc = np.where(y > 0, -(1 - p) / p, 1.0) / n_docs
        g_sentence = s * times * by_doc[doc]
        g = np.append(np.bincount(feature, g_sentence[sentence], len(used)), [g_sentence.sum(), leak * by_doc.sum()])
        g += DECAY * (w - prior)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[used] = w[:-2]
    return Model(weights, float(w[-2]), float(1 / (1 + np.exp(-np.clip(w[-1], -30, 30)))))


def score(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Per row: doc_id, score, and the offending sentences: those that alone
    score at least ``least``, as (start, end, score) in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches):
        weights = Weights(shared.value)
        for batch in batches:
            found = [score_text(t.as_py(), weights) for t in batch.column("text")]
            named = [[{"start": a, "end": b, "score": s} for a, b, s in places if s >= least] for _, places in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), pa.array(named, pa.list_(place))],
                ["doc_id", "score", "sentences"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, score double, sentences array<struct<start:int,end:int,score:double>>")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = Weights(shared.value)
        for texts in batches:
            yield pa.array([score_text(t.as_py(), weights)[0] for t in texts], pa.float64())

    return docs.where(scored("text") < threshold)
