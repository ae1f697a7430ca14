"""Columns of a table may have any name, also one that an operator uses itself."""

import pytest
from pyspark.sql import functions as F

from meterframe.llm import mixing, near_dedup, template_match, toxicity

NAMES = ["_n", "_rate", "_source", "_id", "_text", "_cls", "_doc_id", "a.b", "row", "rate", "of", "n", "gone", "cls", "id", "text_hash", "sentences", "x`y"]
WORDS = "one two three four five six seven eight nine ten"


@pytest.fixture(params=["single ids", "repeated ids"])
def docs(spark, request):
    rows = [(k, f"{WORDS} number {chr(97 + k // 2)} and so on it goes", "s") for k in range(6)]
    if request.param == "repeated ids":
        rows += [rows[0], (1, "another text with quite other words in it", "s"), (None, "without an id", None), (None, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *[F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for i, c in enumerate(NAMES)])


def whole(df, docs):
    """Columns are there, in order, with the values of their row."""
    assert df.columns[: len(docs.columns)] == docs.columns
    rows = df.collect()
    for r in rows:
        mark = "-" if r["doc_id"] is None else str(r["doc_id"])
        assert [r[c] for c in NAMES] == [f"{i}:{mark}" for i in range(len(NAMES))]
    return rows


def test_mix(docs):
    rows = whole(mixing.mix(docs, F.lit(1.0), seed=3, total=200.0), docs)
    assert len(rows) > 100


def test_without_near_duplicates(docs):
    rows = whole(near_dedup.without_near_duplicates(docs), docs)
    texts = [r["text"] for r in rows]
    assert len([t for t in texts if t]) == len({t for t in texts if t})
    assert {t for t in texts if t} <= {r["text"] for r in docs.collect()}


def test_without_benchmark(spark, docs):
    benchmark = spark.createDataFrame([(1, f"{WORDS} number a and so on it goes")], "item_id long, text string")
    rows = whole(template_match.without_benchmark(docs, benchmark), docs)
    left = [r["text"] for r in docs.collect() if WORDS not in (r["text"] or "")]  # they share a window of words
    assert sorted(map(str, (r["text"] for r in rows))) == sorted(map(str, left))


def test_without_toxic(spark, docs):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert len(whole(toxicity.without_toxic(docs, model), docs)) == docs.count()
